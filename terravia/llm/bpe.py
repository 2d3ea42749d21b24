"""Byte-level BPE by a rank queue over a hierarchical bitmap.

The bytes of a pre-token are a linked list. Every neighbouring pair that is in the vocabulary lies in the bucket of its
rank, and a bitmap of two levels marks the ranks whose bucket holds something: find-first-set on the upper word gives a
lower word, find-first-set there gives the next rank. Merging makes at most two new pairs; entries of pairs that no
longer stand are skipped when their bucket comes up. A pre-token of n bytes takes O(n log n) steps at most, so one of a
megabyte is no different from a short one. Within a rank the leftmost pair goes first, and a lower rank that a merge
brings up goes before the rest of the bucket.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terravia.llm.rows import append, without
from terravia.llm.words import give_back, text_chunks

#: Distinct pre-tokens of each of the two generations that a worker remembers, and the longest of them; bytes of text
#: that share a queue.
REMEMBERED, LONGEST = 400_000, 64
TOGETHER = 1 << 20


class Coder:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.byte_pair = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        self.pairs: dict[tuple[int, int], int] = {}
        self.lower = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        # What was used lately, and what was used before that: a full generation becomes the older one, and what is
        # used again comes back from there. So frequent pre-tokens stay, for as long as the worker lives.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Coder:
        """From a file of lines 'base64 rank'."""
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file))}
        return cls(ranks, pattern)

    def _pair(self, pair: tuple[int, int]) -> int:
        """The rank of two neighbours joined, or -1; remembered, as the same pairs come again and again."""
        rank = self.ranks.get(self.tokens[pair[0]] + self.tokens[pair[1]], -1)
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[pair] = rank
        return rank

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, four bytes each. One queue serves them all: their lists are separate, so they do not mix."""
        joined = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = len(joined)
        if not n:
            return [b""] * len(words)
        last = (np.cumsum(lengths) - 1)[lengths > 0]
        first = np.concatenate(([0], last[:-1] + 1))
        start_ids = self.byte[joined]
        if int(start_ids.min()) < 0:
            raise ValueError("the vocabulary lacks a single byte of the text")
        start_ranks = np.full(n, -1, np.int32)
        start_ranks[:-1] = self.byte_pair[(joined[:-1].astype(np.int64) << 8) | joined[1:]]
        start_ranks[last] = -1
        start_after, start_before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        start_after[last], start_before[first] = n, -1
        # rank_at[i]: the rank of the pair that begins at i and stands now.
        ids, rank_at, after, before = (array("i", x.tobytes()) for x in (start_ids, start_ranks, start_after, start_before))

        lower, upper = self.lower, 0
        buckets: dict[int, list[int]] = {}
        order = np.argsort(start_ranks, kind="stable")
        order = order[np.searchsorted(start_ranks[order], 0) :]
        cuts = np.flatnonzero(np.diff(start_ranks[order])) + 1
        for spots in np.split(order, cuts) if len(order) else ():
            rank = rank_at[int(spots[0])]
            buckets[rank] = spots.tolist()
            lower[rank >> 8] |= 1 << (rank & 255)
            upper |= 1 << (rank >> 8)

        get, pair_of = self.pairs.get, self._pair
        while upper:
            block = (upper & -upper).bit_length() - 1
            bits = lower[block]
            rank = (block << 8) + (bits & -bits).bit_length() - 1
            lower[block] = bits = bits & (bits - 1)
            if not bits:
                upper &= upper - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            least = rank
            for k, at in enumerate(bucket):
                if rank_at[at] != rank:
                    continue  # stale: one of the two has been merged since
                right = after[at]
                end = after[at] = after[right]
                ids[at], ids[right], rank_at[right] = rank, -1, -1
                if end < n:
                    before[end] = at
                    pair = (rank, ids[end])
                    r = get(pair)
                    if r is None:
                        r = pair_of(pair)
                    rank_at[at] = r
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(at)
                        else:
                            buckets[r] = [at]
                            lower[r >> 8] |= 1 << (r & 255)
                            upper |= 1 << (r >> 8)
                            if r < least:
                                least = r
                else:
                    rank_at[at] = -1
                i = before[at]
                if i >= 0:
                    pair = (ids[i], rank)
                    r = get(pair)
                    if r is None:
                        r = pair_of(pair)
                    rank_at[i] = r
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            lower[r >> 8] |= 1 << (r & 255)
                            upper |= 1 << (r >> 8)
                            if r < least:
                                least = r
                if least < rank:  # a lower rank has come up: the rest of this bucket waits
                    if k + 1 < len(bucket):
                        buckets[rank] = bucket[k + 1 :]
                        lower[rank >> 8] |= 1 << (rank & 255)
                        upper |= 1 << (rank >> 8)
                    break
        held = np.frombuffer(ids, np.int32)
        stay = held >= 0
        flat = held[stay].tobytes()
        ends = (4 * np.concatenate(([0], np.cumsum(stay)))[np.concatenate(([0], np.cumsum(lengths)))]).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text. The pre-tokens that are new go through the queue together, each once."""
        found = [self.find(t) if t else [] for t in texts]
        missing = set(chain.from_iterable(found)).difference(self.known)
        known, older = self.known, self.older
        again = missing.intersection(older)
        known.update((w, older[w]) for w in again)
        new = list(missing.difference(again))
        known.update(zip(new, self.merge([w.encode() for w in new])))
        for words in found:
            yield np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32).tolist()
        for w in new:
            if len(w) > LONGEST:
                del known[w]
        if len(known) > REMEMBERED:
            self.older, self.known = known, {}

    def encode(self, text: str | None) -> list[int]:
        (ids,) = self.encode_all([text])
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def __enter__(self) -> Coder:
        return self

    def __exit__(self, *_) -> None:
        """At the end of a task: the worker lives on for other work, so what was remembered goes."""
        self.known, self.older, self.pairs = {}, {}, {}


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """One coder per Python worker and vocabulary."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder.load(path, pattern)
    return _CODERS[path, pattern]


def _checked(own: Coder, text: str | None, ids: list[int]) -> list[int]:
    if own.decode(ids) != (text or "").encode():
        raise ValueError("a text does not come back from its ids")
    return ids


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int): the whole text of every row encoded, special tokens not recognised.

    ``path`` names a file of ranks that every executor has at that place. Null and empty texts give no ids. Equal rows
    each get their own; an input column named ``ids`` is replaced. Every text is decoded again in its task, and one
    that does not come back byte for byte is an error.
    """
    docs = without(docs, "ids")
    schema = append(docs.schema, ("ids", T.ArrayType(T.IntegerType())))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        with coder(path, pattern) as own:
            for batch in batches:
                for a, b, texts in text_chunks(batch.column(batch.schema.get_field_index(text)), TOGETHER):
                    coded = (_checked(own, t, x) for t, x in zip(texts, own.encode_all(texts), strict=True))
                    ids = pa.array((np.array(x, np.int32) for x in coded), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, ids], schema.names)

    return docs.mapInArrow(work, schema)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the bytes of the ids; null ids give no bytes."""
    rows = without(rows, "decoded")
    schema = append(rows.schema, ("decoded", T.BinaryType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            bytes_of = pa.array((own.decode(x or ()) for x in column.to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, bytes_of], schema.names)

    return rows.mapInArrow(work, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, and digests of the ids and of the bytes they decode to.

    Ids and bytes of a text exist in the task only while that text is encoded, decoded and hashed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        # What the worker has merged serves its next tasks too.
        own = coder(path, pattern)
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1), TOGETHER):
                n, ids_hash, decoded_hash = [], [], []
                for ids in own.encode_all(texts):
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(" ".join(map(own.names.__getitem__, ids)).encode()).hexdigest())
                    decoded_hash.append(hashlib.sha256(own.decode(ids)).hexdigest())
                columns = [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(decoded_hash, pa.string())], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
