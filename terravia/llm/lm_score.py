"""Cross-entropy difference of two matched n-gram models.

Both models are bigram models over one vocabulary, with the same smoothing: P(w | v) = (c(v, w) + M * P(w)) /
(c(v) + M), P(w) = (c(w) + 1) / (N + V). The vocabulary is the ``VOCABULARY`` most frequent words of all documents, and
``CLASSES`` classes that share all other words by their hash. The target model counts the documents labelled as wanted,
the background model counts all documents. Each word of a document gets -log2 P under both; ``score`` is the mean
target loss less the mean background loss, lower for wanted text.

Every bigram of every document is in the models, however rare, so they grow with the corpus. Counts are summed per
task, then in buckets by the bigram's hash, and written as a table of sorted runs, one a bucket; their number follows
the corpus. A bigram that is at least ``RARE`` of all goes to every task, which are at most 1 / RARE. A document's other
bigrams are sent to their bucket, where they meet its run, and come back as sums a document. ``RARE`` decides only by
which way a bigram is looked up; the scores do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.llm.rows import KEY, with_key
from terravia.llm.words import U, Words, mix, text_chunks
from terravia.session import cut_lineage

#: Words of the vocabulary, classes of all other words, weight of the word model.
VOCABULARY, CLASSES, MASS = 50_000, 1 << 18, 50.0
#: Share of all bigrams from which on one goes to every task; target ids up to which they do.
RARE, FEW_TARGETS = 1 / (1 << 20), 1_000_000
#: Words and bigrams that a task holds before it hands them on; bigrams of the corpus for each bucket.
HELD, BUCKET = 1 << 21, 1 << 22


class Vocabulary:
    """Numbers of words by their hash: first the classes of all other words, then the words themselves."""

    def __init__(self, hashes: np.ndarray, classes: int):
        self.hashes, self.classes = np.sort(hashes), classes
        self.size = classes + len(hashes)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        rest = ((words >> U(20)) % U(self.classes)).astype(np.int64)
        if not len(self.hashes):
            return rest
        at = np.searchsorted(self.hashes, words)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == words, at + self.classes, rest)


def _bigrams(words: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) for every word; a text begins after the first class."""
    right = vocabulary(words.hash)
    left = np.concatenate(([0], right[:-1])) if len(right) else right
    left[words.first[:-1][words.counts() > 0]] = 0
    return left, right


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as bytes: all first bytes, all second ones and so on, which lie close to each other when sorted."""
    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def _pack_sorted(numbers: np.ndarray) -> bytes:
    return _pack(np.diff(numbers, prepend=np.int64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.int64))


def _by_bucket(items: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its items, which stay in order."""
    bucket = (mix(items.astype(np.uint64)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    start = 0
    for end in ends.tolist():
        yield int(bucket[order[start]]), order[start:end]
        start = end


def _summed(batches, code: Callable[[Words], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted code(words), and how often each is in all and in wanted documents, ``HELD`` words at a time. The batches
    hold (wanted, text)."""
    keys: list[np.ndarray] = []
    wanted: list[np.ndarray] = []
    held = 0

    def out():
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(place), np.bincount(place, np.concatenate(wanted), len(key)).astype(np.int64)

    for batch in batches:
        for a, b, texts in text_chunks(batch.column(1)):
            words = Words(texts)
            keys.append(code(words))
            wanted.append(batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)[words.owner()])
            held += len(keys[-1])
            if held >= HELD:
                yield out()
                keys, wanted, held = [], [], 0
    if held:
        yield out()


class Models:
    """What every task holds of both models: the words, and the bigrams of at least ``RARE``, sorted numbers
    left * size + right."""

    def __init__(self, vocabulary: Vocabulary, words: np.ndarray, bigrams: np.ndarray, counts: np.ndarray, buckets: int):
        """``words`` [2, size] and ``counts`` [2, bigram]: of target and background."""
        self.vocabulary, self.bigrams, self.buckets = vocabulary, bigrams, buckets
        total = words.sum(1, keepdims=True)
        self.smooth = MASS * (words + 1) / (total + vocabulary.size)
        self.log_context = np.log2(words + MASS)
        self.gain = self.gains(bigrams, counts)

    def gains(self, bigrams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What the counts of bigrams take off the loss that the words alone give, [2, bigram]."""
        right = bigrams % self.vocabulary.size
        return np.log2((counts + self.smooth[:, right]) / self.smooth[:, right])

    def losses(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Summed losses [2, text] without the gains of bigrams that are not held; those bigrams and their texts."""
        owner, n = words.owner(), len(words.counts())
        left, right = _bigrams(words, self.vocabulary)
        code = left * self.vocabulary.size + right
        known = np.zeros(len(code), bool)
        if len(self.bigrams):
            at = np.searchsorted(self.bigrams, code)
            at[at == len(self.bigrams)] = 0
            known = self.bigrams[at] == code
        sums = []
        for m in (0, 1):
            loss = self.log_context[m][left] - np.log2(self.smooth[m][right])
            if len(self.bigrams):
                loss -= np.where(known, self.gain[m][at], 0.0)
            sums.append(np.bincount(owner, loss, n))
        return np.stack(sums), code[~known], owner[~known]


@dataclass(frozen=True)
class Trained:
    """Models for the tasks, and the table of all bigrams: ``bucket`` and its sorted run (``items``, ``n``, ``target``)."""

    models: Models
    bigrams: DataFrame


RUNS = "bucket long, items binary, n binary, target binary"


def _runs(made) -> pa.RecordBatch:
    bucket, items, n, target = zip(*made, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(items, pa.binary()), pa.array(n, pa.binary()), pa.array(target, pa.binary())],
        ["bucket", "items", "n", "target"],
    )


def _merge(table: pa.Table) -> pa.Table:
    """The runs of a bucket as one."""
    items = np.concatenate([_unpack_sorted(d) for d in table["items"].to_pylist()])
    key, place = np.unique(items, return_inverse=True)
    sums = [np.bincount(place, np.concatenate([_unpack(d, np.int64) for d in table[c].to_pylist()]), len(key)) for c in ("n", "target")]
    n, target = (_pack(s.astype(np.int64)) for s in sums)
    return pa.Table.from_batches([_runs([(table["bucket"][0].as_py(), _pack_sorted(key), n, target)])])


def _marked(docs: DataFrame, targets: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(wanted, text) of every document: ids are sent to all tasks up to ``FEW_TARGETS``, else both sides are shuffled."""
    ids = targets.select(F.col(doc_id).cast("long").alias("id")).dropna().distinct().withColumn("wanted", F.lit(True))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    wanted = F.coalesce("wanted", F.lit(False)).alias("wanted")
    if ids.limit(FEW_TARGETS + 1).count() <= FEW_TARGETS:
        return rows.join(F.broadcast(ids), "id", "left").select(wanted, "text")
    # rows without an id would all be one key
    named = rows.filter("id is not null").join(ids, "id", "left").select(wanted, "text")
    return named.unionByName(rows.filter("id is null").select(F.lit(False).alias("wanted"), "text"))


def train(
    docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text",
    vocabulary: int = VOCABULARY, classes: int = CLASSES, rare: float = RARE, bucket: int = BUCKET,
) -> Trained:
    """Both models. ``targets`` holds the integer ids of wanted documents, all of which are counted; a null or unknown
    id adds nothing, a repeated one counts once. Of ``docs``, repeated rows count as often as they occur, rows with a
    null id count in the background only, and null texts, like empty ones, add nothing."""
    spark = docs.sparkSession
    rows = _marked(docs, targets, doc_id, text)

    def count_words(batches):
        for key, n, target in _summed(batches, lambda words: words.hash.view(np.int64)):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(target)], ["item", "n", "target"])

    kind = "item long, n long, target long"
    counted = rows.mapInArrow(count_words, kind).groupBy("item").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    counted = cut_lineage(counted, "word-counts")
    top = counted.orderBy(F.desc("n"), "item").limit(vocabulary).toPandas()
    hashes = top["item"].to_numpy(np.int64).view(np.uint64)
    known = Vocabulary(hashes, classes)
    words = np.zeros((2, known.size))
    rest = counted.groupBy((F.shiftrightunsigned("item", 20) % classes).alias("class")).agg(F.sum("target"), F.sum("n")).toPandas()
    words[:, rest["class"].to_numpy(np.int64)] = rest.iloc[:, 1:].to_numpy(np.float64).T
    counts = top[["target", "n"]].to_numpy(np.float64).T
    for m in (0, 1):
        # the classes were summed over all words
        words[m] -= np.bincount(((hashes >> U(20)) % U(classes)).astype(np.int64), counts[m], known.size)
    words[:, known(hashes)] = counts
    total = float(words[1].sum())
    buckets = max(1, -int(-total // bucket))
    shared = spark.sparkContext.broadcast(known)

    def count_bigrams(batches):
        vocabulary = shared.value

        def code(words):
            left, right = _bigrams(words, vocabulary)
            return left * vocabulary.size + right

        for key, n, target in _summed(batches, code):
            yield _runs([(b, _pack_sorted(key[at]), _pack(n[at]), _pack(target[at])) for b, at in _by_bucket(key, buckets)])

    bigrams = cut_lineage(rows.mapInArrow(count_bigrams, RUNS).groupBy("bucket").applyInArrow(_merge, RUNS), "bigrams")

    def frequent(batches):
        for batch in batches:
            for row in batch.to_pylist():
                items, n, target = _unpack_sorted(row["items"]), _unpack(row["n"], np.int64), _unpack(row["target"], np.int64)
                at = n >= max(1.0, total * rare)
                yield pa.RecordBatch.from_arrays([pa.array(items[at]), pa.array(n[at]), pa.array(target[at])], ["item", "n", "target"])

    got = bigrams.mapInArrow(frequent, kind).toPandas().sort_values("item")
    return Trained(Models(known, words, got["item"].to_numpy(np.int64), got[["target", "n"]].to_numpy(np.float64).T, buckets), bigrams)


PARTS = "bucket long, home long, items binary, owners binary, keys binary, words binary, losses binary"
FOUND = "home long, keys binary, copies binary, words binary, losses binary"
SUMS = "key long, copies long, n long, target double, background double"


def _parts(batches, held: Broadcast) -> Iterator[pa.RecordBatch]:
    """The bigrams of (key, text) that are not in every task, by bucket; the sums of the texts go with one of the parts.
    ``home`` is where the sums of these texts are put together."""
    models = held.value
    window: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        keys, n, losses, items, owners = (np.concatenate(x, axis=-1) for x in zip(*window, strict=True))
        order = np.argsort(items, kind="stable")
        items, owners = items[order], owners[order]
        made = []
        for bucket, at in _by_bucket(items, models.buckets):
            texts, owner = np.unique(owners[at], return_inverse=True)
            made.append([bucket, _pack_sorted(items[at]), _pack(owner.astype(np.uint32)), _pack(keys[texts]), None, None])
        # which bucket takes the sums follows from the texts, so that all take their share
        home = int(mix(keys[:1].view(np.uint64))[0] % U(models.buckets))
        made.append([home, None, None, _pack(keys), _pack(n), _pack(losses.reshape(-1))])
        rows = [(b, home, *rest) for b, *rest in made]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.binary()] * 5, strict=True)],
            ["bucket", "home", "items", "owners", "keys", "words", "losses"],
        )

    texts_held = 0
    for batch in batches:
        for a, b, texts in text_chunks(batch.column(1)):
            words = Words(texts)
            losses, items, owners = models.losses(words)
            keys = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)
            window.append((keys, words.counts().astype(np.int64), losses, items, owners + texts_held))
            texts_held += len(keys)
            size += len(items) + len(keys)
            if size >= HELD:
                yield out()
                window, size, texts_held = [], 0, 0
    if size:
        yield out()


def _added(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, copies, words, losses [2, key]) with every key once."""
    keys, copies, words, losses = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
    key, place = np.unique(keys, return_inverse=True)
    copies, words = (np.bincount(place, c, len(key)).astype(np.int64) for c in (copies, words))
    return key, copies, words, np.stack([np.bincount(place, x, len(key)) for x in losses])


def _looked_up(parts: pa.Table, runs: pa.Table, held: Broadcast) -> pa.Table:
    """What one bucket knows, a row for each home: its bigrams' gains by document, and the losses sent with them."""
    models = held.value
    known, gain = np.empty(0, np.int64), np.zeros((2, 0))
    if runs.num_rows:
        known = _unpack_sorted(runs["items"][0].as_py())
        counts = np.stack([_unpack(runs[c][0].as_py(), np.int64) for c in ("target", "n")])
        gain = models.gains(known, counts)
    found: dict[int, list[tuple]] = {}
    for part in parts.select(["home", "items", "owners", "keys", "words", "losses"]).to_pylist():
        keys = _unpack(part["keys"], np.int64)
        if part["items"] is None:
            made = (np.ones(len(keys), np.int64), _unpack(part["words"], np.int64), _unpack(part["losses"], np.float64).reshape(2, -1))
        else:
            items, owner = _unpack_sorted(part["items"]), _unpack(part["owners"], np.uint32)
            sums, none = np.zeros((2, len(keys))), np.zeros(len(keys), np.int64)
            if len(known):
                at = np.searchsorted(known, items)
                at[at == len(known)] = 0
                same = known[at] == items
                sums = np.stack([-np.bincount(owner[same], gain[m][at[same]], len(keys)) for m in (0, 1)])
            made = (none, none, sums)
        found.setdefault(part["home"], []).append((keys, *made))
    rows = []
    for home in sorted(found):
        key, copies, words, losses = _added(found.pop(home))
        rows.append((home, _pack_sorted(key), _pack(copies), _pack(words), _pack(losses.reshape(-1))))
    columns = zip(*rows, strict=True) if rows else [()] * 5
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["home", "keys", "copies", "words", "losses"])


def _at_home(found: pa.Table) -> pa.Table:
    """Sums by document of all buckets."""
    key, copies, words, losses = _added([
        (_unpack_sorted(r["keys"]), _unpack(r["copies"], np.int64), _unpack(r["words"], np.int64), _unpack(r["losses"], np.float64).reshape(2, -1))
        for r in found.to_pylist()
    ])
    return pa.table([pa.array(c) for c in (key, copies, words, *losses)], names=["key", "copies", "n", "target", "background"])


def score(docs: DataFrame, trained: Trained, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``target_bits`` and ``background_bits`` (means per word) and
    ``score``, their difference. Null texts and texts without words have no tokens and null means. Equal rows each get
    their own row; ids may repeat or be null."""
    held = docs.sparkSession.sparkContext.broadcast(trained.models)
    keyed = with_key(docs.select(doc_id, text), doc_id, text)
    parts = keyed.select(KEY, F.col(text).alias("text")).mapInArrow(lambda batches: _parts(batches, held), PARTS)
    met = parts.groupBy("bucket").cogroup(trained.bigrams.groupBy("bucket"))
    # packed by home on their way back, as a document has bigrams in most of the buckets
    found = met.applyInArrow(lambda part, run: _looked_up(part, run, held), FOUND)
    sums = found.groupBy("home").applyInArrow(_at_home, SUMS)
    sums = sums.groupBy(F.col("key").alias(KEY)).agg(*[F.sum(c).alias(f"_{c}") for c in ("copies", "n", "target", "background")])
    mean = {m: F.when(F.col("_n") > 0, F.col(f"_{m}") / F.col("_n")) for m in ("target", "background")}
    return keyed.select(F.col(doc_id), KEY).join(sums, KEY, "left").select(
        doc_id,
        F.expr("_n div _copies").alias("n_tokens"),
        mean["target"].alias("target_bits"),
        mean["background"].alias("background_bits"),
        (mean["target"] - mean["background"]).alias("score"),
    )
