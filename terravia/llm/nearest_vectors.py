"""Nearest vectors by a block matrix join in int8, with exact recomputation of what the bounds leave.

A unit vector x is kept as scale * q + e with q in int8 and |e| known. For two such vectors the true product differs
from the int8 one by at most |a||f| + |e||b| + |e||f| (a, b the rounded vectors, e, f the residuals), so a tile of int8
products gives an upper bound for every cosine of the tile. A pair whose bound lies under the k-th best cosine that is
already known for its query is dropped; the others are computed again in double precision and go into the query's heap.
The result is therefore exact.

Queries are a stated set, taken in blocks of a bounded number of bytes. A block is sent to every task; tasks read their
own candidates tile by tile and return at most k rows per query. A first pass over a bounded sample of candidates gives
each query a k-th best to start from, which is only used to prune.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.session import cut_lineage

#: Bytes of a block of queries, candidates of a tile, and candidates that give the first bounds.
BLOCK_BYTES, TILE, SEED_ROWS = 16 << 20, 2048, 4096


def vectors(ids: pa.Array, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and double vectors of the rows that take part, by length of the vector."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        flat = column.flatten().cast(pa.float64())
        lengths = np.diff(column.offsets.to_numpy()) if column.null_count == 0 else None
        if lengths is not None and flat.null_count == 0 and ids.null_count == 0 and len(lengths) and (lengths == lengths[0]).all():
            x = flat.to_numpy(zero_copy_only=False).reshape(len(lengths), -1)
            keep = np.isfinite(x).all(1) & (np.abs(x).max(1, initial=0) > 0)
            return ids.to_numpy(zero_copy_only=False)[keep], [x[keep]]
    out_ids, rows = [], []
    for i, v in zip(ids.to_pylist(), column.to_pylist(), strict=True):
        if i is None or v is None or any(c is None for c in v):
            continue
        x = np.array(v, np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            out_ids.append(i)
            rows.append(x)
    return np.array(out_ids, np.int64), [np.array([r]) for r in rows]


def by_length(ids: np.ndarray, parts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each length of vector: only vectors of equal length are compared."""
    if len(parts) == 1 and len(parts[0]) == len(ids):
        if len(ids):
            yield ids, parts[0]
        return
    groups: dict[int, list[int]] = {}
    for i, p in enumerate(parts):
        groups.setdefault(p.shape[1], []).append(i)
    for where in groups.values():
        yield ids[where], np.concatenate([parts[i] for i in where])


class Block:
    """Vectors in double, and as int8 with the norms that bound the error."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, np.ascontiguousarray(x)
        # Scaled first, so that squares of very large or small components stay finite.
        top = np.abs(self.x).max(1, keepdims=True)
        self.unit = self.x / top
        self.norm = np.sqrt((self.unit * self.unit).sum(1))
        self.unit /= self.norm[:, None]
        scale = np.abs(self.unit).max(1, keepdims=True) / 127
        self.q = np.rint(self.unit / scale).astype(np.int8)
        rounded = self.q * scale
        self.scale = scale[:, 0]
        self.rest = np.sqrt(((self.unit - rounded) ** 2).sum(1))
        self.size = np.sqrt((rounded**2).sum(1))
        self.top = top[:, 0]

    def upper(self, other: Block) -> np.ndarray:
        """Upper bounds of all cosines with another block."""
        # int8 products of up to 1040 components are whole numbers that float32 adds without error.
        kind = np.float32 if self.q.shape[1] <= 1040 else np.float64
        product = self.q.astype(kind) @ other.q.T.astype(kind)
        bound = product.astype(np.float64) * self.scale[:, None] * other.scale[None, :]
        bound += self.size[:, None] * other.rest[None, :] + self.rest[:, None] * (other.size + other.rest)[None, :]
        return bound + 1e-9

    def cosines(self, mine: np.ndarray, other: Block, theirs: np.ndarray) -> np.ndarray:
        """Cosines of the given pairs from the original vectors, in double."""
        a, b = self.x[mine], other.x[theirs]
        plain = (self.top < 1e100) & (self.top > 1e-100)
        if not (plain[mine].all() and ((other.top < 1e100) & (other.top > 1e-100))[theirs].all()):
            a, b = a / self.top[mine, None], b / other.top[theirs, None]
        return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


class Heaps:
    """The k best candidates of each query: highest score, then smallest id."""

    def __init__(self, queries: Block, k: int, floor: np.ndarray):
        self.queries, self.k, self.floor = queries, k, floor.copy()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]

    def add(self, tile: Block) -> None:
        rows, columns = np.nonzero(self.queries.upper(tile) >= self.floor[:, None])
        keep = self.queries.ids[rows] != tile.ids[columns]
        rows, columns = rows[keep], columns[keep]
        for at in range(0, len(rows), 1 << 16):
            r, c = rows[at : at + (1 << 16)], columns[at : at + (1 << 16)]
            scores = self.queries.cosines(r, tile, c)
            good = scores >= self.floor[r]
            r, c, scores = r[good], c[good], scores[good]
            # The best k ids of each query in this tile are enough for its heap.
            order = np.lexsort((-scores, tile.ids[c], r))
            r, c, scores = r[order], c[order], scores[order]
            once = np.append(True, (np.diff(r) != 0) | (np.diff(tile.ids[c]) != 0)) if len(r) else np.empty(0, bool)
            r, c, scores = r[once], c[once], scores[once]
            order = np.lexsort((tile.ids[c], -scores, r))
            r, c, scores = r[order], c[order], scores[order]
            first = np.flatnonzero(np.diff(r, prepend=-1))
            place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
            r, c, scores = r[place < self.k], c[place < self.k], scores[place < self.k]
            for i, v, s in zip(r.tolist(), tile.ids[c].tolist(), scores.tolist(), strict=True):
                heap = self.heaps[i]
                if (held := next((h for h in heap if h[1] == -v), None)) is not None:
                    if s > held[0]:
                        heap[heap.index(held)] = (s, -v)
                        heapq.heapify(heap)
                elif len(heap) < self.k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
                if len(heap) == self.k and heap[0][0] > self.floor[i]:
                    self.floor[i] = heap[0][0]

    def rows(self) -> tuple[list[int], list[int], list[float]]:
        out = [(int(q), -v, s) for q, heap in zip(self.queries.ids, self.heaps, strict=True) for s, v in heap]
        return [o[0] for o in out], [o[1] for o in out], [o[2] for o in out]


def _search(candidates: DataFrame, blocks: list[tuple[Block, np.ndarray]], k: int) -> DataFrame:
    held = candidates.sparkSession.sparkContext.broadcast([(b.ids, b.x, floor) for b, floor in blocks])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {x.shape[1]: Heaps(Block(ids, x), k, floor) for ids, x, floor in held.value}
        for batch in batches:
            for ids, x in by_length(*vectors(batch.column(0), batch.column(1))):
                if x.shape[1] in heaps:
                    for at in range(0, len(ids), TILE):
                        heaps[x.shape[1]].add(Block(ids[at : at + TILE], x[at : at + TILE]))
        for h in heaps.values():
            q, v, s = h.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                ["query_id", "vec_id", "score"],
            )

    return candidates.mapInArrow(work, "query_id long, vec_id long, score double")


def nearest_vectors(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
    seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """The ``k`` candidates of largest cosine for each query: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller vec_id; a candidate with the query's own id is left out; fewer than k candidates give all of
    them. Scores are cosines in double precision of the original vectors. Rows with a null id, and vectors that are
    null, empty, zero or hold a null or non-finite component take no part; only vectors of equal length are compared.
    Rows that repeat an id and a vector count once; an id with several vectors keeps its best. Other columns are
    ignored. No queries or no candidates give an empty result.
    """
    spark = queries.sparkSession
    candidates = candidates.select(F.col(vec_id).cast("long"), vector)
    asked = queries.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("x")).dropna()
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = max(1, block_bytes // (8 * max(1, size["d"])))
    n_blocks = -(-size["n"] // rows)
    seeds = list(by_length(*_local(candidates.orderBy(F.xxhash64(vec_id), vec_id).limit(seed_rows))))
    found = None
    for b in range(n_blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b)
        blocks = []
        for ids, x in by_length(*_local(part)):
            block = Block(ids, x)
            start = Heaps(block, k, np.full(len(ids), -np.inf))
            for seed_ids, seed_x in seeds:
                if seed_x.shape[1] == x.shape[1]:
                    _, once = np.unique(seed_ids, return_index=True)
                    for at in range(0, len(once), TILE):
                        start.add(Block(seed_ids[once[at : at + TILE]], seed_x[once[at : at + TILE]]))
            blocks.append((block, start.floor))
        one = _search(candidates, blocks, k)
        if n_blocks > 1:
            one = cut_lineage(one, "nearest")
        found = one if found is None else found.unionByName(one)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    entry = F.struct((-F.col("score")).alias("order"), "vec_id", "score")
    # Merged in two steps, so that a query's rows from very many tasks never meet at once.
    top = F.slice(F.sort_array(F.collect_list("entry")), 1, k).alias("top")
    parts = best.select("query_id", entry.alias("entry"), F.pmod("vec_id", F.lit(64)).alias("part"))
    parts = parts.groupBy("query_id", "part").agg(top).select("query_id", F.explode("top").alias("entry"))
    return (
        parts.groupBy("query_id")
        .agg(top)
        .select("query_id", F.posexplode("top"))
        .select(
            "query_id",
            (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("col.vec_id").alias("vec_id"),
            F.col("col.score").alias("score"),
        )
    )


def _local(rows: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """A bounded number of rows on the driver."""
    got = rows.toArrow()
    return vectors(got.column(0).combine_chunks(), got.column(1).combine_chunks())
