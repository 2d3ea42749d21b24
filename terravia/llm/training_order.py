"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed stride.

Documents are tokenised and packed, task by task, into sequences of ``LENGTH`` ids with an end mark after each text;
the last sequence of a task is filled up. With the sequences of all tasks counted, a sequence has a number in [0, N).
A Feistel network over the next even power of two permutes the numbers; results of N or more go through it again
(cycle-walking), which leaves a permutation of [0, N) that the key alone decides: the sequence's slot.

Slot s is in shard s // ``SHARD`` at byte (s % ``SHARD``) * stride. Shards are the ranges of the partitioning, so each
is sorted and written by one task; a file appears under its name only when it is whole, and writing it again gives the
same bytes. A reader takes them one after the other, or seeks to the slot it stopped at.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravia.llm.words import mix, text_chunks
from terravia.session import cut_lineage, scratch_path

#: Ids of a sequence, sequences of a shard, rounds of the network, effort of the compression between tasks.
LENGTH, SHARD, ROUNDS, EFFORT = 4096, 1024, 6, 6
END, DTYPE = 50256, np.dtype("<u2")


def feistel(number: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of [0, n): each number's slot."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(rounds, dtype=np.uint64) + np.uint64(key % (1 << 64)))
    out = np.array(number, np.uint64)
    walk = np.ones(len(out), bool)
    while walk.any():
        x = out[walk]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[walk] = (left << np.uint64(half)) | right
        walk = out >= np.uint64(n)
    return out.astype(np.int64)


_ENCODERS: dict = {}


def encoder(path: str, pattern: str):
    """The library's coder for a file of ranks, one per Python worker."""
    if (path, pattern) not in _ENCODERS:
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file))}
        _ENCODERS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path, pattern]


def sequences(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """(part, seq, n_tokens, doc_ids, payload): the packed sequences of each task, compressed.

    ``doc_ids`` are the documents that have ids in the sequence, in order; null ids are left out of it. A text longer
    than a sequence goes on in the next. Null texts are skipped, empty ones are an end mark.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, squeeze = encoder(path, pattern), zstandard.ZstdCompressor(level=EFFORT)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        held, docs_in = 0, []
        out: list[tuple] = []

        def close(tokens: np.ndarray) -> None:
            nonlocal seq
            n, full = len(tokens), np.full(length, end, DTYPE)
            full[:n] = tokens
            out.append((seq, n, [d for d in docs_in if d is not None], squeeze.compress(full.tobytes())))
            seq += 1

        def batch_of() -> pa.RecordBatch:
            s, n, d, p = zip(*out, strict=True)
            made = [pa.array([part] * len(out), pa.int32()), pa.array(s, pa.int32()), pa.array(n, pa.int32()), pa.array(d, pa.list_(id_type)), pa.array(p, pa.binary())]
            out.clear()
            return pa.RecordBatch.from_arrays(made, ["part", "seq", "n_tokens", "doc_ids", "payload"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for a, b, texts in text_chunks(batch.column(1), 1 << 20):
                for doc, t in zip(batch.column(0).slice(a, b - a).to_pylist(), texts, strict=True):
                    if t is None:
                        continue
                    new = np.array(coder.encode_ordinary(t) + [end], DTYPE)
                    docs_in.append(doc)
                    while held + len(new) >= length:
                        room = length - held
                        close(np.concatenate([*ids, new[:room]]))
                        ids, held, new = [], 0, new[room:]
                        docs_in = [doc] if len(new) else []
                    if len(new):
                        ids.append(new)
                        held += len(new)
                if out:
                    yield batch_of()
        if held:
            close(np.concatenate(ids))
            yield batch_of()

    return docs.select(doc_id, text).mapInArrow(
        work, f"part int, seq int, n_tokens int, doc_ids array<{kind}>, payload binary"
    )


def in_training_order(packed: DataFrame, key: int, shard: int = SHARD) -> tuple[DataFrame, int]:
    """``packed`` (read from a table) with ``number``, ``slot`` and ``shard``, and the number of sequences."""
    # One row per task of the tokenising job: its sequences, and those of the tasks before it.
    sizes = packed.groupBy("part").count()
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut_lineage(sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"), "count"), "offsets")
    n = offsets.agg(F.sum("count")).first()[0] or 0

    @F.pandas_udf("long")
    def slot(number):
        import pandas as pd

        return pd.Series(feistel(number.to_numpy(np.int64), n, key))

    numbered = packed.join(offsets.select("part", "offset"), "part").withColumn("number", F.col("offset") + F.col("seq"))
    placed = numbered.withColumn("slot", slot("number")).withColumn("shard", F.floor(F.col("slot") / shard).cast("int"))
    return placed.drop("offset"), n


def write_shards(placed: DataFrame, n: int, folder: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Write ``shard-00000.bin`` and so on below ``folder``, which all executors reach; one row per sequence.

    A row has slot, shard, byte offset in the shard, n_tokens and doc_ids. The files are written when the result is
    evaluated.
    """
    stride = length * DTYPE.itemsize
    kind = placed.schema["doc_ids"].dataType.simpleString()
    # The partition is the shard itself: a range of slots.
    rows = placed.select("slot", "shard", "n_tokens", "doc_ids", "payload")
    ranged = rows.repartitionById(max(1, -(-n // shard)), F.col("shard")).sortWithinPartitions("slot")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        stream = name = temporary = None
        at = -1

        def finish() -> None:
            stream.close()
            store.move(temporary, name)

        for batch in batches:
            for slot, where, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4)), strict=True):
                if where != at:
                    if stream is not None:
                        finish()
                    at, name = where, posixpath.join(root, f"shard-{where:05d}.bin")
                    temporary = f"{name}.{TaskContext.get().taskAttemptId()}"
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(temporary)
                stream.write(opener.decompress(payload, max_output_size=stride))
            slots = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slots % shard * stride), batch.column(2), batch.column(3)],
                ["slot", "shard", "offset", "n_tokens", "doc_ids"],
            )
        if stream is not None:
            finish()

    return ranged.mapInArrow(work, f"slot long, shard int, offset long, n_tokens int, doc_ids {kind}")


def read_sequences(folder: str, slot: int, count: int, length: int = LENGTH, shard: int = SHARD) -> np.ndarray:
    """The ids of ``count`` sequences from ``slot`` on, as a reader that resumes takes them: [count, length]."""
    stride = length * DTYPE.itemsize
    store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    parts = []
    while count > 0:
        where, first = divmod(slot, shard)
        take = min(count, shard - first)
        with store.open_input_file(posixpath.join(root, f"shard-{where:05d}.bin")) as file:
            file.seek(first * stride)
            parts.append(np.frombuffer(file.read(take * stride), DTYPE).reshape(-1, length))
        slot, count = slot + take, count - take
    return np.concatenate(parts) if parts else np.empty((0, length), DTYPE)


def materialise(docs: DataFrame, path: str, pattern: str, key: int = 17, folder: str | None = None, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Tokenise, order and write ``docs`` (doc_id, text); see ``sequences`` and ``write_shards`` for rows and rules.

    Repeated rows are packed each; no documents give no sequences and no files. Other columns are ignored. ``folder``
    is a new one in the shared folder unless given.
    """
    packed = cut_lineage(sequences(docs, path, pattern, length=length), "sequences")
    placed, n = in_training_order(packed, key, shard)
    return write_shards(placed, n, folder or scratch_path(docs.sparkSession, "shards"), length, shard)
