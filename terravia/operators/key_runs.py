"""Key checks that go on from what was checked before: only new rows meet the stored keys, which are never shuffled.

The keys of every batch are stored once as a *run*: a table of key values and their row counts, bucketed and sorted by a
hash of the key. A new batch becomes a run of the same buckets and is joined with each earlier run bucket by bucket, so
the plan has no exchange. Runs of about the same size are merged, so there are at most logarithmically many and a key is
rewritten as often. What is violated so far is kept beside the runs. A small manifest in versions names all of it: a
batch that fails, or comes late, changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.operators.quality import _any_null, _keys
from terravia.operators.tiles import CO_PARTITION
from terravia.sources import versions

HASH, COUNT = "_h", "n"
#: A run is merged with the newer ones when it has at most this many times their keys.
RATIO = 2
MANIFEST = "kind string, folder string, n long, buckets int"


def _state(spark: SparkSession, path: str) -> tuple[int, list]:
    """Number of the current manifest and its rows, oldest run first."""
    number = max(versions.versions(spark, path), default=0)
    if not number:
        return 0, []
    return number, versions.read_version(spark, path, number).orderBy("kind", F.desc("n"), "folder").collect()


def _table(spark: SparkSession, path: str, row) -> DataFrame:
    """A stored run as a bucketed table, also in a session whose catalog does not know it yet."""
    name, place = f"keys_{row['folder']}", f"{path}/{row['folder']}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(place).schema)
        spark.sql(
            f"create table {name} ({columns}) using parquet clustered by ({HASH}) sorted by ({HASH}) into {row['buckets']} buckets "
            f"location '{place}'"
        )
    return spark.table(name)


def _store(df: DataFrame, path: str, buckets: int) -> dict:
    folder = uuid.uuid4().hex
    # dealt as the buckets are, so a task writes one file
    dealt = df.repartition(buckets, HASH).sortWithinPartitions(HASH)
    dealt.write.option("path", f"{path}/{folder}").bucketBy(buckets, HASH).sortBy(HASH).saveAsTable(f"keys_{folder}")
    n = df.sparkSession.table(f"keys_{folder}").count()
    return {"kind": "run", "folder": folder, "n": n, "buckets": buckets}


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys], a[HASH] == b[HASH])


def _hashed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn(HASH, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))


def _merged(spark: SparkSession, path: str, runs: list, keys: list[str]) -> DataFrame:
    # read as plain files: a union of bucketed tables is taken for one that is dealt by the hash, which it is not
    files = spark.read.parquet(*[f"{path}/{r['folder']}" for r in runs])
    return files.groupBy(*keys, HASH).agg(F.sum(COUNT).alias(COUNT)).select(*keys, COUNT, HASH)


def add_keys(batch: DataFrame, keys, path: str, buckets: int | None = None) -> DataFrame:
    """Store the keys of a batch; the key values of this batch that break the primary key, with their rows ``n`` in all
    batches: those that are repeated, within the batch or with an earlier one, or hold a NULL.

    ``keys`` and their types are those of the first batch; ``buckets`` is set by it (by default the session's shuffle
    partitions). The setting ``CO_PARTITION`` of the session is turned off, so that rows dealt by the hash may be joined
    by hash and key. Of two runs that add at the same time, the later one fails and may be repeated.
    """
    spark, keys, path = batch.sparkSession, _keys(keys), path.rstrip("/")
    if {HASH, COUNT} & set(keys):
        raise LayerError(f"a key column may not be named {HASH!r} or {COUNT!r}")
    spark.conf.set(CO_PARTITION, "false")
    number, state = _state(spark, path)
    runs = [r for r in state if r["kind"] == "run"]
    columns = [F.col(f"`{k}`") for k in keys]
    if runs:
        kept = _table(spark, path, runs[0])
        if kept.columns != [*keys, COUNT, HASH]:
            raise LayerError(f"{path} holds the keys {kept.columns[:-2]}")
        columns = [c.cast(kept.schema[k].dataType).alias(k) for c, k in zip(columns, keys, strict=True)]
        buckets = runs[0]["buckets"]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = batch.select(*columns).groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))
    added = _store(_hashed(counted, keys), path, buckets)
    broken = met_by(spark, path, added, runs, keys).where((F.col(COUNT) > 1) | _any_null(keys))
    folder = uuid.uuid4().hex
    broken.write.parquet(f"{path}/{folder}-new")
    broken = spark.read.schema(broken.schema).parquet(f"{path}/{folder}-new")
    earlier = [r for r in state if r["kind"] == "broken"]
    every = broken
    if earlier:
        before = spark.read.schema(broken.schema).parquet(f"{path}/{earlier[0]['folder']}")
        every = before.join(broken, [before[k].eqNullSafe(broken[k]) for k in keys], "left_anti").unionByName(broken)
    every.write.parquet(f"{path}/{folder}")
    kept_runs, last = [*runs], [added]
    while kept_runs and kept_runs[-1]["n"] <= RATIO * sum(r["n"] for r in last):
        last.append(kept_runs.pop())
    if len(last) > 1:
        last = [_store(_merged(spark, path, last, keys), path, buckets)]
    rows = [(r["kind"], r["folder"], r["n"], r["buckets"]) for r in [*kept_runs, *last]] + [("broken", folder, 0, 0)]
    versions.write_version(spark.createDataFrame(rows, MANIFEST).coalesce(1), path, base=number)
    return broken


def met_by(spark: SparkSession, path: str, added, runs: list, keys: list[str]) -> DataFrame:
    """The keys of a stored run with their rows in it and in the earlier ``runs``; nothing is shuffled."""
    found = _table(spark, path, added)
    for i, row in enumerate(runs):
        other = _table(spark, path, row).withColumnRenamed(COUNT, f"_n{i}")
        # merged, not broadcast: both sides are sorted by the hash already
        joined = found.join(other.hint("merge"), _same(found, other, keys), "left")
        found = joined.select(*[found[k] for k in keys], (found[COUNT] + F.coalesce(other[f"_n{i}"], F.lit(0))).alias(COUNT), found[HASH])
    return found.select(*keys, COUNT)


def broken_keys(spark: SparkSession, path: str) -> DataFrame:
    """What the full check over all batches would return: repeated key values and those with a NULL, with their rows."""
    path = path.rstrip("/")
    _, state = _state(spark, path)
    if not state:
        raise LayerError(f"{path} has no keys")
    return spark.read.parquet(f"{path}/{next(r['folder'] for r in state if r['kind'] == 'broken')}")


def repeated_keys(spark: SparkSession, path: str) -> DataFrame:
    """The repeated key values without a NULL, as the full check of a unique key would return them."""
    broken = broken_keys(spark, path)
    return broken.where(~_any_null([c for c in broken.columns if c != COUNT]))


def without_parent(child: DataFrame, child_keys, path: str) -> DataFrame:
    """Rows whose key is in no stored batch of the parent; a key with a NULL passes.

    The new rows are dealt once to the buckets of the stored keys, which stay where they are as long as there are at least
    as many buckets as the session has shuffle partitions.
    """
    spark, child_keys, path = child.sparkSession, _keys(child_keys), path.rstrip("/")
    spark.conf.set(CO_PARTITION, "false")
    _, state = _state(spark, path)
    runs = [r for r in state if r["kind"] == "run"]
    rows = child.where(~_any_null(child_keys))
    if not runs:
        return rows
    keys = _table(spark, path, runs[0]).columns[:-2]
    kinds = _table(spark, path, runs[0]).schema
    wanted = [f"_k{i}" for i in range(len(keys))]
    if len(keys) != len(child_keys):
        raise LayerError(f"{path} holds the keys {keys}")
    for w, k, c in zip(wanted, keys, child_keys, strict=True):
        rows = rows.withColumn(w, F.col(f"`{c}`").cast(kinds[k].dataType))
    rows = rows.withColumn("_kh", F.xxhash64(*wanted))
    for row in runs:
        stored = _table(spark, path, row)
        on = reduce(lambda x, y: x & y, [rows[w] == stored[k] for w, k in zip(wanted, keys, strict=True)], rows["_kh"] == stored[HASH])
        rows = rows.join(stored.hint("merge"), on, "left_anti")
    return rows.drop(*wanted, "_kh")
