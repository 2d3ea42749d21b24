"""Near duplicates by Order MinHash.

A text is the sequence of its shingles of five words, each labelled with how often it has occurred before. A sketch is
made by a random order of the labelled shingles: the ``CHOSEN`` least of them, put back into text order, hashed to one
number. Two texts share a sketch if they share those shingles in the same order, so sketches follow edit similarity and
not only the set of shingles. Two texts are compared if they share one of ``SKETCHES`` sketches. Texts of few shingles
have too few choices for that: up to ``SHORT`` shingles, what is left after leaving out as many shingles as similarity
allows (none, one or two) are the sketches, so that any similar pair with a text that short shares one.

Comparison is an alignment of the two sequences of shingles within a band. With m shingles in the longest common
subsequence the similarity is m / (n1 + n2 - m), and the band is as wide as the least similarity allows. Labels do not
repeat, so on them the subsequence is the longest increasing run of places; where that falls short although enough
labels are shared (a change in repeated text shifts the labels after it), the band is filled in full.

Texts with the same words are one class before any sketch is made. Within a bucket each class is first compared with the
``CENTRES`` texts whose sketches are shared most, which is linear and joins most large groups. What is still in several
components is then compared in full: in a bucket of at most ``FEW`` texts pair by pair, in a larger one in blocks of
texts, where shared shingles are counted by a product of matrices and only pairs with enough of them are aligned. Pairs
within one component are left out, and so are those of the bucket's largest component with itself. The links' components
are the groups. Joins with texts are sorted ones at every size.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravia.llm.components import components
from terravia.llm.rows import KEY, one_per_key, with_key
from terravia.llm.words import U, Words, mix, shingles, signed, text_chunks
from terravia.session import cut_lineage

#: Words of a shingle, least similarity, sketches of a text, shingles of a sketch.
SIZE, SIMILAR, SKETCHES, CHOSEN = 5, 0.8, 24, 5
#: Centres of a bucket, texts of a bucket that are few, texts and words of a block of a larger one.
CENTRES, FEW, BLOCK, BLOCK_WORDS = 2, 16, 256, 1 << 17
#: Shingles that a product of matrices takes at once.
COLUMNS = 4096
#: Shingles of a text up to which similar pairs share a sketch for certain.
SHORT = 10
_ORDERS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def labelled(words: Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the labelled shingles of all texts, where each text's begin (one more entry at the end), and the
    numbers without the labels.

    A text of fewer words than a shingle is one shingle of all its words; one without words has none.
    """
    counts = words.counts()
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(n)), n)
    at = words.first[owner] + np.arange(int(first[-1])) - first[owner]
    long = counts[owner] >= size
    numbers = np.zeros(len(at), np.uint64)
    if long.any():
        numbers[long] = shingles(words.hash, size)[at[long]]
    for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        numbers[first[i]] = shingles(words.hash[words.first[i] : words.first[i + 1]], int(counts[i]))[0]
    own = mix(numbers ^ mix(owner.astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    new = np.append(True, np.diff(own[order]) != 0) if len(own) else np.empty(0, bool)
    start = np.flatnonzero(new)
    turn = np.empty(len(own), np.int64)
    turn[order] = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return mix(numbers + turn.astype(np.uint64) * U(0x9E3779B97F4A7C15)), first, numbers


def sketches(labels: np.ndarray, n: int = SKETCHES, chosen: int = CHOSEN) -> np.ndarray:
    """The sketches of one text from its labelled shingles."""
    take = min(chosen, len(labels))
    out = np.full(n, take, np.uint64)
    orders = _ORDERS[:n, None]
    if len(labels) * n > 1 << 22:  # a very long text: the least of each piece, then of all
        step = (1 << 22) // n
        picked = []
        for at in range(0, len(labels), step):
            piece = labels[None, at : at + step] * orders
            some = min(take, piece.shape[1])
            picked.append(np.argpartition(piece, some - 1, axis=1)[:, :some] + at)
        places = np.concatenate(picked, 1)
        best = np.argpartition(labels[places] * orders, take - 1, axis=1)[:, :take]
        places = np.take_along_axis(places, best, 1)
    else:
        places = np.argpartition(labels[None, :] * orders, take - 1, axis=1)[:, :take]
    places.sort(axis=1)
    for j in range(take):
        out = mix(out * U(0x2545F4914F6CDD1D) + labels[places[:, j]])
    return mix(out + np.arange(n, dtype=np.uint64))


@cache
def _left_over(n: int, out: int) -> np.ndarray:
    """The places that are left of ``n`` after leaving out ``out`` of them, one row for each choice."""
    return np.array(list(combinations(range(n), n - out)), np.int64)


def short_sketches(plain: np.ndarray) -> np.ndarray:
    """The sketches of a text of few shingles, given without labels: its subsequences that can reach ``SIMILAR``."""
    n = len(plain)
    found = []
    for out in range(int(n * (1 - SIMILAR) + 1e-9) + 1):
        places = _left_over(n, out)
        total = np.full(len(places), n - out, np.uint64)
        for j in range(n - out):
            total = mix(total * U(0x2545F4914F6CDD1D) + plain[places[:, j]])
        found.append(total)
    return np.unique(mix(np.concatenate(found) + U(0x9E3779B97F4A7C15)))


def all_sketches(labels: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """All sketches of a text, given with and without labels."""
    n = len(labels)
    # A longer text can be similar to a short one.
    short = short_sketches(plain) if n * SIMILAR <= SHORT + 1e-9 else np.empty(0, np.uint64)
    return short if n <= SHORT else np.concatenate((short, sketches(labels)))


def common_subsequence(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose pairs (i, j) have |i - j| <= band."""
    width = 2 * band + 1
    best = np.zeros(width, np.int32)  # by j - i + band
    padded = np.concatenate((np.zeros(band, np.uint64), b, np.zeros(band + len(a), np.uint64)))
    real = np.concatenate((np.zeros(band, bool), np.ones(len(b), bool), np.zeros(band + len(a), bool)))
    for i in range(len(a)):
        best += (padded[i : i + width] == a[i]) & real[i : i + width]
        above = best.copy()
        above[:-1] = before[1:] if i else 0
        best = np.maximum.accumulate(np.maximum(best, above))
        before = best.copy()
    return int(best.max())


def alignment(a: np.ndarray, b: np.ndarray, plain_a: np.ndarray, plain_b: np.ndarray, least: float = SIMILAR) -> float:
    """Similarity of two sequences, given with and without labels, if it is at least ``least``, else 0."""
    n = len(a) + len(b)
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    need = least * n / (1 + least) - 1e-9  # m / (n - m) >= least
    order = np.argsort(b)
    place = np.searchsorted(b[order], a)
    place[place == len(b)] = 0
    there = order[place]
    i = np.flatnonzero(b[there] == a)
    j = there[i]
    if len(j) < need:
        return 0.0  # not even as sets
    band = int(n - 2 * need)
    j = j[np.abs(i - j) <= band]
    if (np.diff(j) > 0).all():
        m = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        m = len(tails)
    if m < need:
        m = common_subsequence(plain_a, plain_b, band)
    return m / (n - m) if m >= need else 0.0


def _describe(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, key, number of words, a 128-bit number of the word sequence and the sketches."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, {KEY} long, n_words long, c1 long, c2 long, sketches array<long>"
    names = ["doc_id", KEY, "n_words", "c1", "c2", "sketches"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(2)):
                words = Words(texts)
                counts = words.counts()
                owner = words.owner()
                spot = (np.arange(len(owner)) - words.first[owner]).astype(np.uint64)
                sums = []
                for seed in (U(1), U(2)):
                    total = np.concatenate(([U(0)], np.cumsum(mix(words.hash + mix(spot * U(2) + seed)))))
                    sums.append(mix(total[words.first[1:]] - total[words.first[:-1]] + counts.astype(np.uint64)))
                labels, first, plain = labelled(words)
                rows = [signed(all_sketches(labels[x:y], plain[x:y])) if y > x else () for x, y in zip(first, first[1:])]
                part = batch.slice(a, b - a)
                columns = [part.column(0), part.column(1), pa.array(counts, pa.int64())]
                columns += [*(pa.array(signed(s)) for s in sums), pa.array(rows, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(doc_id, KEY, text).mapInArrow(work, schema)


def _verified(pairs: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(a, b, similarity) for pairs (a, b), 0 where they are not similar. Texts travel only to the pairs they are in."""
    texts = docs.select(F.col(KEY).alias("_k"), F.col(text).alias("_t"))
    both = (
        pairs.join(texts.hint("merge"), F.col("a") == F.col("_k"))
        .select("a", "b", F.col("_t").alias("ta"))
        .join(texts.hint("merge"), F.col("b") == F.col("_k"))
        .select("a", "b", "ta", F.col("_t").alias("tb"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, left in text_chunks(batch.column(2), 1 << 20):
                right = batch.column(3).slice(a, b - a).to_pylist()
                found = []
                for x, y in zip(left, right, strict=True):
                    labels, first, plain = labelled(Words([x, y]))
                    n = first[1]
                    found.append(alignment(labels[:n], labels[n:], plain[:n], plain[n:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(found, pa.float64())],
                    ["a", "b", "similarity"],
                )

    return both.mapInArrow(work, "a long, b long, similarity double")


def block_links(ids: list[int], groups: list[int], sides: np.ndarray, texts: list[str]) -> list[tuple[int, int, float]]:
    """Links that join the groups of the texts: between the sides 0 and 1, or within side 0 if there is no other.

    Every pair of texts of different groups is either found not similar or in groups that the links join.
    """
    labels, first, plain = labelled(Words(texts))
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    _, place, often = np.unique(labels, return_inverse=True, return_counts=True)
    # A shingle of one text is in no pair; labels do not repeat in a text.
    number = np.cumsum(often > 1) - 1
    kept = often[place] > 1
    owner, column = owner[kept], number[place[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1) if (sides == 1).any() else left
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        has = np.zeros((len(size), COLUMNS), np.float32)
        has[owner[a:b], column[a:b] - low] = 1
        common += has[left] @ has[right].T
    need = SIMILAR * (size[left][:, None] + size[right][None, :]) / (1 + SIMILAR) - 1e-9
    group = np.array(groups, np.int64)
    near = (common >= need) & (group[left][:, None] != group[right][None, :])
    if right is left:
        near = np.triu(near, 1)
    x, y = np.nonzero(near)
    order = np.argsort(-common[x, y], kind="stable")
    root: dict[int, int] = {}

    def top(g: int) -> int:
        while (up := root.get(g, g)) != g:
            root[g] = g = root.get(up, up)
        return g

    found = []
    for i, j in zip(left[x[order]].tolist(), right[y[order]].tolist(), strict=True):
        g, h = top(groups[i]), top(groups[j])
        if g == h:
            continue
        a, b = slice(first[i], first[i + 1]), slice(first[j], first[j + 1])
        similarity = alignment(labels[a], labels[b], plain[a], plain[b])
        if similarity > 0:
            root[max(g, h)] = min(g, h)
            found.append((min(ids[i], ids[j]), max(ids[i], ids[j]), similarity))
    return found


def _block_links(open_rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Links (a, b, similarity) that join the groups (``label``) of the texts of each bucket, compared in blocks."""
    main = open_rows.groupBy("bucket").agg(F.mode("label").alias("main"))
    rows = open_rows.join(cut_lineage(main, "main-groups"), "bucket").withColumn("own", F.col("label") == F.col("main"))
    counts = rows.groupBy("bucket").agg(
        *(F.greatest(F.lit(1), F.ceil(F.greatest(F.sum(own.cast("long")) / BLOCK, F.sum(F.when(own, F.col("n_words"))) / BLOCK_WORDS))).cast("int").alias(name)
          for name, own in (("n_own", F.col("own")), ("n_other", ~F.col("own"))))
    )
    rows = rows.join(cut_lineage(counts, "blocks"), "bucket")
    spot = F.xxhash64("a", "bucket")
    # The blocks of the main group come after the others and meet only those.
    block = F.when(F.col("own"), F.col("n_other") + F.pmod(spot, F.col("n_own"))).otherwise(F.pmod(spot, F.col("n_other"))).cast("int")
    last = F.when(F.col("own"), F.col("n_other")).otherwise(F.col("n_other") + F.col("n_own")) - 1
    rows = rows.select("bucket", "a", "label", block.alias("block"), last.alias("last"))
    texts = docs.select(F.col(KEY).alias("_k"), F.col(text).alias("t"))
    rows = rows.join(texts.hint("merge"), F.col("a") == F.col("_k"))
    rows = rows.select("bucket", "a", "label", "t", "block", F.explode(F.sequence(F.lit(0), "last")).alias("with"))
    rows = rows.select(
        "bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        (F.col("block") > F.col("with")).cast("int").alias("side"), "a", "label", "t",
    )

    def work(block: pa.Table) -> pa.Table:
        columns = [block.column(c).to_pylist() for c in ("a", "label", "t")]
        sides = block.column("side").to_numpy()
        two = block.column("i")[0].as_py() != block.column("j")[0].as_py()
        found = block_links(columns[0], columns[1], sides, columns[2]) if not two or 0 < sides.sum() < len(sides) else []
        kinds = {"a": pa.int64(), "b": pa.int64(), "similarity": pa.float64()}
        return pa.table({n: pa.array([f[i] for f in found], t) for i, (n, t) in enumerate(kinds.items())})

    return rows.groupBy("bucket", "i", "j").applyInArrow(work, "a long, b long, similarity double")


def near_links(docs: DataFrame, keys: DataFrame, text: str = "text") -> DataFrame:
    """Verified links (a, b, similarity) between the classes' representatives, whose sketches ``keys`` holds. Any two
    texts that share a sketch and are similar are linked, directly or through others."""
    entries = keys.select(F.col(KEY).alias("a"), "n_words", F.explode("sketches").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut_lineage(entries.join(sizes, "bucket"), "buckets")
    # How often a text's sketches are shared: the text that others were copied from has the most.
    mass = shared.groupBy("a").agg(F.sum("n").alias("mass"))
    shared = cut_lineage(shared.join(mass, "a"), "buckets")
    wanted = shared.select(F.col("a").alias(KEY)).distinct().hint("merge")
    docs = cut_lineage(docs.select(KEY, text).join(wanted, KEY, "left_semi"), "texts")

    # The row limit is applied in every task before the shuffle, so a bucket's rows do not meet.
    most = Window.partitionBy("bucket").orderBy(F.desc("mass"), "a")
    heads = shared.withColumn("rank", F.row_number().over(most)).filter(F.col("rank") <= CENTRES)
    heads = cut_lineage(heads.select("bucket", F.col("a").alias("b")), "centres")

    def pairs_of(tries: DataFrame) -> DataFrame:
        return tries.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    tries = shared.select("bucket", "a").join(heads, "bucket").filter("a != b")
    done = cut_lineage(_verified(pairs_of(tries), docs, text), "links")
    groups = components(done.filter("similarity > 0")).withColumnRenamed("node", "a")
    tagged = shared.join(groups, "a", "left").withColumn("label", F.coalesce("label", "a"))
    tagged = cut_lineage(tagged.select("bucket", "a", "n", "n_words", "label"), "groups")
    several = tagged.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    rest = cut_lineage(tagged.join(several.select("bucket"), "bucket", "left_semi"), "open")
    few = rest.filter(F.col("n") <= FEW)
    other = few.select("bucket", F.col("a").alias("b"), F.col("label").alias("label_b"))
    tries = few.join(other, "bucket").filter("a < b and label != label_b")
    pairs = pairs_of(tries).join(done.select("a", "b"), ["a", "b"], "left_anti")
    more = cut_lineage(_verified(pairs, docs, text), "links")
    many = cut_lineage(_block_links(rest.filter(F.col("n") > FEW), docs, text), "links")
    best = many.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    return done.unionByName(more).unionByName(best).filter("similarity > 0").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``n_links``, ``n_copies`` and the document's ``_key``.

    Documents with one ``class_id`` are near duplicates of each other, directly or through others; it is the least key
    of them, that is the least doc_id where ids are unique (see ``with_key``). ``n_links`` counts the links of this text
    that were verified, not all texts similar to it: pairs that are in one class by then are not compared. ``n_copies``
    counts the documents with the same words, itself included. Texts without words (null, empty, punctuation) are a
    class each. A text shorter than a shingle is one shingle. Rows equal in id and text share key and class. No
    documents give no rows.

    A pair with similarity s shares a sketch with probability about 1 - (1 - s**5)**24, which is over 0.9999 at 0.8 for
    long texts, over 0.999 from 11 shingles on, and certain if one of the two has at most 10. Any pair
    that shares one is compared unless both are known to be of one class by then; buckets have no row limit. So a group
    whose texts are mostly not similar to each other, though they share sketches, costs the square of its size.
    """
    keyed = with_key(docs.select(doc_id, text), doc_id, text)
    about = cut_lineage(_describe(keyed, doc_id, text), "sketches")
    classes = about.filter("n_words > 0").groupBy("c1", "c2").agg(F.min(KEY).alias("rep"), F.count("*").alias("n_copies"))
    classes = cut_lineage(classes, "classes")
    reps = about.join(classes.select(F.col("rep").alias(KEY)), KEY).dropDuplicates([KEY])
    links = cut_lineage(near_links(keyed, reps, text), "near-links")
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep")
    groups = components(links).withColumnRenamed("node", "rep").join(ends.agg(F.count("*").alias("n_links")), "rep")
    label = F.coalesce("label", "rep").alias("class_id")
    member = cut_lineage(classes.join(groups, "rep", "left").select("c1", "c2", label, "n_links", "n_copies"), "members")
    return about.join(member, ["c1", "c2"], "left").select(
        F.col("doc_id").alias(doc_id),
        F.coalesce("class_id", KEY).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        KEY,
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with their own columns, that stand for their class: one row for each class."""
    keep = near_duplicates(docs, doc_id, text).filter(F.col("class_id") == F.col(KEY)).select(KEY).distinct()
    keyed = with_key(docs.select(F.struct("*").alias("_row"), doc_id, text), doc_id, text)
    kept = keyed.join(cut_lineage(keep, "kept").hint("merge"), KEY, "left_semi")
    return one_per_key(kept).select("_row.*")
