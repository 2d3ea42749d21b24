"""Words of a batch of texts as 64-bit numbers, and the hashing that the operators share.

A word is a longest run of ASCII digits, ASCII letters and bytes from 0x80 on, after A-Z is lower-cased; this is the
pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on the text. Null is a text without words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np

SEPARATOR = 0x20
#: Byte for byte: A-Z to a-z; digits, a-z and everything from 0x80 stay; the rest separates words.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else SEPARATOR
    for b in range(256)
)
#: Bytes that are hashed at once; a text is cut between words, so memory does not follow its length.
PIECE = 1 << 19
#: Bytes of text handled together in a task.
CHUNK = 1 << 20

U = np.uint64
_SPOTS = np.random.Generator(np.random.PCG64(20240917)).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word in folded bytes that end with a separator."""
    inside = data != SEPARATOR
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return start, end, np.empty(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    spot = np.arange(int(first[-1] + length[-1])) - np.repeat(first, length)
    by = _SPOTS[spot & 63]
    if int(length.max()) > 64:
        by = by * (mix((spot >> 6).astype(np.uint64)) | U(1))
    total = np.add.reduceat((data[inside].astype(np.uint64) + U(1)) * by, first)
    return start, end, mix(total + length.astype(np.uint64) * U(0x9E3779B97F4A7C15))


class Words:
    """The words of some texts, one after the other.

    ``hash`` has a number per word, ``first`` the index of each text's first word (and one more entry at the end),
    ``start`` and ``end`` the place of each word in ``data``, the folded bytes of all texts, in which text i begins
    at ``base[i]``.
    """

    def __init__(self, texts: list[str | None]):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.base = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
        self.data = (b" ".join(raw) + b" ").translate(FOLD)
        starts, ends, hashes, at = [], [], [], 0
        while at < len(self.data):
            to = min(at + PIECE, len(self.data))
            if to < len(self.data):
                to = self.data.index(SEPARATOR, to - 1) + 1
            s, e, h = _hashes(np.frombuffer(self.data, np.uint8, to - at, at))
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
            at = to
        self.start, self.end, self.hash = np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
        self.first = np.searchsorted(self.start, self.base)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A number for every run of ``size`` neighbouring words; the runs that cross texts are for the caller to leave out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += hashes[j : j + n] * _SPOTS[j % 64] if j < 64 else mix(hashes[j : j + n] + U(j))
    return mix(out + U(size))


def chunks(sizes: list[int], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of at most ``limit`` bytes, or one row."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > limit:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def _trim():
    """The C library's way of handing freed memory back to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


_TRIM = _trim()


def give_back() -> None:
    """Return what a worker has freed: it lives on between tasks, and other stages need the memory."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    _TRIM(0)


def text_chunks(column, limit: int = CHUNK) -> Iterator[tuple[int, int, list[str | None]]]:
    """An Arrow string column as lists of texts, a bounded number of bytes at a time."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in chunks(sizes, limit):
        yield a, b, column.slice(a, b - a).to_pylist()


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as a signed number, which is what Spark's long holds."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
