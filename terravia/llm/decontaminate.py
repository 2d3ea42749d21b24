"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

Every run of ``window`` words of an item is a set of word shingles. The shingles are ordered by how rare they are in the
documents, and of a window with m shingles of which c must match, only the m - c + 1 rarest (its necessary prefix) can
start a candidate: a match has at least one of them. A candidate fixes where the window would lie, so the length and
positional bounds are one comparison, and it is verified shingle by shingle over the item-sized window.

The documents are never shuffled. The items are the query set: they are taken in blocks of a bounded number of bytes,
and each block is one counting pass and one joining pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.llm.rows import append, without
from terravia.llm.words import U, Words, give_back, mix, shingles, text_chunks
from terravia.session import cut_lineage

#: Words of a window, of a shingle, and bytes of item text that one pass holds.
WINDOW, SHINGLE, BLOCK_BYTES = 10, 3, 8 << 20

HITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))


class Windows:
    """The distinct windows of a block of items, their shingles and, once ranked, their prefix tokens."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int, threshold: float):
        self.threshold = threshold
        words = Words([text for _, text in items])
        found: dict[bytes, set[str]] = {}
        for i, (item, _) in enumerate(items):
            own = words.hash[words.first[i] : words.first[i + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                found.setdefault(own[at : at + size].tobytes(), set()).add(item)
        hashes = [np.frombuffer(k, np.uint64) for k in found]
        self.length = np.array([len(h) for h in hashes], np.int64)
        self.size = np.minimum(shingle, self.length)
        self.m = self.length - self.size + 1
        self.sets = np.zeros((len(hashes), int(self.m.max()) if hashes else 0), np.uint64)
        for w, h in enumerate(hashes):
            # A shingle's size is part of its number, so windows of all lengths share one table.
            self.sets[w, : self.m[w]] = shingles(h, int(self.size[w]))
        self.items = [sorted(v) for v in found.values()]
        inside = np.arange(self.sets.shape[1]) < self.m[:, None]
        self.vocabulary = np.unique(self.sets[inside])
        self.prefix = self.window_of = self.offset = np.empty(0, np.int64)

    def rank(self, frequency: np.ndarray) -> None:
        """Take the prefix of each window; ``frequency`` counts the vocabulary in the documents."""
        tokens, windows, offsets = [], [], []
        for w in range(len(self.m)):
            own = self.sets[w, : self.m[w]]
            need = max(1, math.ceil(self.threshold * len(own) - 1e-9))
            order = np.lexsort((own, frequency[np.searchsorted(self.vocabulary, own)]))
            for o in order[: len(own) - need + 1]:
                tokens.append(own[o])
                windows.append(w)
                offsets.append(o)
        order = np.argsort(np.array(tokens, np.uint64), kind="stable")
        self.prefix = np.array(tokens, np.uint64)[order]
        self.window_of, self.offset = np.array(windows, np.int64)[order], np.array(offsets, np.int64)[order]


    def lookups(self) -> dict[int, Lookup]:
        """The prefix tokens of each shingle size, with their first places in the prefix table."""
        found = {size: Lookup(np.unique(self.prefix[self.size[self.window_of] == size])) for size in sorted(set(self.size.tolist()))}
        for lookup in found.values():
            lookup.first = np.searchsorted(self.prefix, lookup.values)
        return found


class Lookup:
    """Members of a sorted array among many numbers, by a bitmap first."""

    BITS = 20

    def __init__(self, values: np.ndarray):
        self.values = values
        self.map = np.zeros(1 << self.BITS, bool)
        self.map[(values & U((1 << self.BITS) - 1)).astype(np.int64)] = True

    def __call__(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``numbers`` that hold a value, and the first place of that value."""
        at = np.flatnonzero(self.map[(numbers & U((1 << self.BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        found = np.searchsorted(self.values, numbers[at])
        same = self.values[np.minimum(found, len(self.values) - 1)] == numbers[at]
        return at[same], found[same]


def _joined(words: Words, w: Windows, lookups: dict[int, Lookup]) -> tuple[np.ndarray, np.ndarray]:
    """Verified occurrences: the index of their first word and their window."""
    begins, windows = [], []
    owner = words.owner()
    for size, lookup in lookups.items():
        numbers = shingles(words.hash, size)
        at, found = lookup(numbers)
        last = np.searchsorted(w.prefix, numbers[at], side="right")
        many = last - found
        at = np.repeat(at, many)
        entry = np.repeat(found - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        window, begin = w.window_of[entry], at - w.offset[entry]
        keep = w.size[window] == size
        at, window, begin = at[keep], window[keep], begin[keep]
        text = owner[at]
        # Positional and length bounds: the whole window lies inside the text of its token.
        keep = (begin >= words.first[text]) & (begin + w.length[window] <= words.first[text + 1])
        window, begin = window[keep], begin[keep]
        same = np.zeros(len(begin), np.int64)
        for j in range(w.sets.shape[1]):
            on = np.flatnonzero(j < w.m[window])
            same[on] += numbers[begin[on] + j] == w.sets[window[on], j]
        keep = same >= np.maximum(1, np.ceil(w.threshold * w.m[window] - 1e-9))
        begins.append(begin[keep])
        windows.append(window[keep])
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(begins), np.concatenate(windows)


def _runs(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "stop": b} for a, b in out]


def _frequency(docs: DataFrame, text: str, w: Windows) -> np.ndarray:
    """How often each shingle of the block occurs in all documents: one sum per task, added by Spark."""
    vocabulary = docs.sparkSession.sparkContext.broadcast((w.vocabulary, sorted(set(w.size.tolist()))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        values, sizes = vocabulary.value
        lookup, total = Lookup(values), np.zeros(len(values), np.int64)
        for batch in batches:
            for _, _, texts in text_chunks(batch.column(0)):
                words = Words(texts)
                for size in sizes:
                    _, found = lookup(shingles(words.hash, size))
                    total += np.bincount(found, minlength=len(values))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])

    rows = docs.select(text).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(len(w.vocabulary), np.int64)
    got = rows.toPandas()
    out[got["token"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    vocabulary.unpersist()
    return out


def _block(docs: DataFrame, text: str, items: list[tuple[str, str]], window: int, shingle: int, threshold: float) -> DataFrame:
    """Documents with ``n_words``, ``hits`` and ``items``, added to those that earlier blocks found."""
    w = Windows(items, window, shingle, threshold)
    w.rank(_frequency(docs, text, w))
    held = docs.sparkSession.sparkContext.broadcast(w)
    before = "hits" in docs.columns
    kept = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    schema = append(
        docs.select(*kept).schema, ("n_words", T.LongType()), ("hits", HITS), ("items", T.ArrayType(T.StringType()))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        lookups = w.lookups()
        hits_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(a, b - a)
                words = Words(texts)
                begin, window = _joined(words, w, _Firsts.of(lookups))
                spans: list[list] = [[] for _ in texts]
                seen: list[set] = [set() for _ in texts]
                if before:
                    for i, (h, s) in enumerate(zip(part.column("hits").to_pylist(), part.column("items").to_pylist(), strict=True)):
                        spans[i] += [(x["start"], x["stop"]) for x in h]
                        seen[i].update(s)
                if len(begin):
                    text_of = np.searchsorted(words.first, begin, side="right") - 1
                    base = words.first[text_of]
                    pairs = np.unique(np.stack([text_of, begin - base, begin - base + w.length[window]], 1), axis=0)
                    for i, x, y in pairs.tolist():
                        spans[i].append((x, y))
                    for i, k in np.unique(np.stack([text_of, window], 1), axis=0).tolist():
                        seen[i].update(w.items[k])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [
                        pa.array(words.counts(), pa.int64()),
                        pa.array([_runs(s) for s in spans], hits_type),
                        pa.array([sorted(s) for s in seen], pa.list_(pa.string())),
                    ],
                    schema.names,
                )

    return docs.mapInArrow(join, schema)


class _Firsts:
    """A lookup whose places are those in the whole prefix table."""

    def __init__(self, lookup: Lookup):
        self.lookup = lookup

    def __call__(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, found = self.lookup(numbers)
        return at, self.lookup.first[found]

    @staticmethod
    def of(lookups: dict[int, Lookup]) -> dict:
        return {size: _Firsts(lookup) for size, lookup in lookups.items()}


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    threshold: float = 1.0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add to every row of ``docs`` what it shares with the items.

    ``n_words``: words of the text. ``hits``: the runs of words [start, stop) that lie inside an occurrence of a
    window. ``items``: ids, as strings, of the items with an occurring window, sorted. A window is ``window``
    neighbouring words of an item; an item of fewer words is one window. With ``threshold`` 1 an occurrence has all
    shingles of the window in place, so the same words (compared by 64-bit numbers); below 1 that share of them.

    Null or empty texts have no words and no hits. Items without words or without id are left out; rows with the same
    item id are one item. Equal documents each get their own row. Input columns named like a result are replaced.
    Without items every document has no hits.
    """
    docs = without(docs, "n_words", "hits", "items")
    for b, block in enumerate(_blocks(items, item_id, item_text, block_bytes)):
        docs = _block(cut_lineage(docs, "overlaps") if b else docs, text, block, window, shingle, threshold)
    return docs


def _blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items, a bounded number of bytes at a time; at least one block."""
    source = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).dropna()
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        yield [tuple(r) for r in source.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()]


def _shares(held):
    """Does a text hold an occurrence of a window of the broadcast block? Only texts go to the workers."""

    @F.arrow_udf(T.BooleanType())
    def shares(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        w = held.value
        lookups = w.lookups()
        for column in columns:
            found = []
            for a, b, texts in text_chunks(column):
                words = Words(texts)
                begin, _ = _joined(words, w, _Firsts.of(lookups))
                hit = np.zeros(b - a, bool)
                hit[np.searchsorted(words.first, begin, side="right") - 1] = True
                found.append(hit)
            yield pa.array(np.concatenate(found) if found else np.empty(0, bool))

    return shares


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    threshold: float = 1.0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that share no window with an item (see ``find_overlaps``), with their own columns."""
    for block in _blocks(items, item_id, item_text, block_bytes):
        w = Windows(block, window, shingle, threshold)
        w.rank(_frequency(docs, text, w))
        docs = docs.filter(~_shares(docs.sparkSession.sparkContext.broadcast(w))(F.col(text)))
    return docs


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: counts of words, hit words and items, and a digest of the items' ids."""
    found = find_overlaps(docs.select("doc_id", "text"), items, **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT u, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT dw.u, dw.i, dw.n, bw.item FROM dw JOIN bw USING (n, g)),
hit AS (SELECT u, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT u, unnest(range(i, i + n)) AS k FROM m) GROUP BY u),
its AS (SELECT u, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT u, item FROM m) GROUP BY u)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (u) LEFT JOIN its USING (u)
"""
