"""Keys checked batch by batch: the same violations as the full check, and the stored keys stay where they are."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.operators import key_runs, quality
from terravia.session import scratch_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batches(spark, seed, sizes, span):
    chance = random.Random(seed)
    pick = lambda: None if chance.random() < 0.05 else chance.randrange(span)
    for size in sizes:
        yield spark.createDataFrame([(pick(), str(chance.randrange(4)), 0) for _ in range(size)], "a int, b string, n int")


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_same_violations_as_the_full_check(spark, keys):
    path, so_far = scratch_path(spark, "keys"), None
    for batch in batches(spark, 3, [60, 40, 0, 5, 90, 7], 120):
        found = key_runs.add_keys(batch, keys, path, buckets=4)
        so_far = batch if so_far is None else so_far.unionByName(batch)
        full = rows(quality.check_primary_key(so_far, keys))
        assert rows(key_runs.broken_keys(spark, path)) == full
        assert rows(key_runs.repeated_keys(spark, path)) == rows(quality.check_unique(so_far, keys))
        mine = {tuple(r) for r in batch.select(*keys).collect()}
        assert rows(found) == [r for r in full if r[:-1] in mine]


def test_runs_stay_few_and_survive_a_new_catalog(spark):
    path = scratch_path(spark, "keys")
    for i in range(12):
        key_runs.add_keys(spark.range(i * 10, i * 10 + 10), "id", path, buckets=2)
    _, state = key_runs._state(spark, path)
    runs = [r for r in state if r["kind"] == "run"]
    assert len(runs) <= 4 and sum(r["n"] for r in runs) == 120
    for r in runs:
        spark.sql(f"drop table keys_{r['folder']}")
    # another type of the same numbers is the same key
    found = key_runs.add_keys(spark.range(115, 125).select(F.col("id").cast("int").alias("id")), "id", path)
    assert rows(found) == [(i, 2) for i in range(115, 120)]


def test_only_new_rows_move(spark):
    path = scratch_path(spark, "keys")
    key_runs.add_keys(spark.range(1000), "id", path, buckets=8)
    key_runs.add_keys(spark.range(100), "id", path)
    _, state = key_runs._state(spark, path)
    runs = [r for r in state if r["kind"] == "run"]
    assert len(runs) == 2
    met = key_runs.met_by(spark, path, runs[1], runs[:1], ["id"])
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    orphans = key_runs.without_parent(spark.range(990, 1010).withColumn("v", F.lit(1)), "id", path)
    assert orphans._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1
    assert rows(orphans) == [(i, 1) for i in range(1000, 1010)]


def test_a_batch_that_fails_changes_nothing(spark):
    path = scratch_path(spark, "keys")
    key_runs.add_keys(spark.range(5), "id", path, buckets=2)
    bad = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        key_runs.add_keys(bad, "id", path)
    assert rows(key_runs.broken_keys(spark, path)) == []
    assert rows(key_runs.add_keys(spark.range(4, 6), "id", path)) == [(4, 2)]
    with pytest.raises(LayerError):
        key_runs.add_keys(spark.range(3).withColumnRenamed("id", "other"), "other", path)
    with pytest.raises(LayerError):
        key_runs.broken_keys(spark, scratch_path(spark, "none"))


def test_children_without_a_parent(spark):
    path = scratch_path(spark, "keys")
    child = spark.createDataFrame([(1, "x"), (2, "x"), (None, "x"), (9, None), (9, "y"), (3, "z"), (3, "z")], "p long, q string")
    assert key_runs.without_parent(child, ["p", "q"], path).count() == 5
    parents = spark.createDataFrame([(1, "x"), (3, "y"), (None, "x")], "a int, b string")
    key_runs.add_keys(parents, ["a", "b"], path, buckets=3)
    left = key_runs.without_parent(child, ["p", "q"], path)
    assert rows(left) == rows(quality.check_foreign_key(child, ["p", "q"], parents, ["a", "b"])) == [(2, "x"), (3, "z"), (3, "z"), (9, "y")]
    key_runs.add_keys(spark.createDataFrame([(3, "z")], "a int, b string"), ["a", "b"], path)
    assert rows(key_runs.without_parent(left, ["p", "q"], path)) == [(2, "x"), (9, "y")]
