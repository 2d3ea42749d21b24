"""Profiles merged from kept sketches against those of all rows."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.operators import profile, sketches
from terravia.session import scratch_path

SCHEMA = "a long, b double, c string, d date, e timestamp, f boolean, g decimal(10,2), `odd name` int"


def part(spark, seed, n):
    chance = random.Random(seed)
    some = lambda v: None if chance.random() < 0.1 else v
    rows = [(
        some(chance.randrange(20000)), some(chance.gauss(seed, 3)), some("abc"[min(2, int(chance.expovariate(1)))]),
        some(date(2020, 1, 1) + timedelta(chance.randrange(400))), some(datetime(2020, 1, 1) + timedelta(seconds=chance.randrange(10**6))),
        some(chance.random() < 0.3), some(chance.randrange(500)), None,
    ) for _ in range(n)]
    return spark.createDataFrame(rows, "a long, b double, c string, d date, e timestamp, f boolean, g long, `odd name` int").withColumn(
        "g", F.col("g").cast("decimal(10,2)")
    ).select(*[F.col(f"`{c}`") for c in ("a", "b", "c", "d", "e", "f", "g", "odd name")])


def check(spark, path, every):
    exact = {r["column_name"]: r for r in profile.column_profile(every, exact=True).collect()}
    got = {r["column_name"]: r for r in sketches.merged_profile(spark, path).collect()}
    assert set(got) == set(exact)
    values = {c: [r[0] for r in every.select(F.col(f"`{c}`")).collect()] for c in got}
    for c, r in got.items():
        e = exact[c]
        assert (r["n_rows"], r["n_nulls"], r["min_value"], r["max_value"]) == (e["n_rows"], e["n_nulls"], e["min_value"], e["max_value"])
        assert r["n_distinct"] == pytest.approx(e["n_distinct"], rel=0.03)
    for c in ("a", "b", "g"):
        found = sorted(float(v) for v in values[c] if v is not None)
        for q, at in zip(got[c]["quartiles"], sketches.QUARTERS, strict=True):
            below, upto = sum(v < q for v in found) / len(found), sum(v <= q for v in found) / len(found)
            assert below - 0.02 <= at <= upto + 0.02
    for c in ("c", "f"):
        counts = Counter(str(v).lower() if c == "f" else v for v in values[c] if v is not None)
        assert {f["value"]: f["n"] for f in got[c]["frequent"]} == dict(counts)
    assert got["odd name"]["quartiles"] is None and not got["odd name"]["frequent"] and got["c"]["quartiles"] is None


def test_merged_like_all_rows_and_a_reload_reads_its_partition_only(spark):
    path = scratch_path(spark, "sketches")
    parts = {"p1": part(spark, 1, 3000), "p2": part(spark, 2, 5000), "p3": part(spark, 3, 0)}
    for name, df in parts.items():
        sketches.add_partition(df, name, path)
    check(spark, path, parts["p1"].unionByName(parts["p2"]))
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    again = part(spark, 7, 1000)
    sketches.add_partition(again.mapInArrow(seen, again.schema), "p1", path)
    assert read.value == 1000
    check(spark, path, again.unionByName(parts["p2"]))


def test_a_load_that_fails_or_has_other_columns_changes_nothing(spark):
    path = scratch_path(spark, "sketches")
    sketches.add_partition(spark.range(10), "x", path)
    with pytest.raises(PySparkException):
        sketches.add_partition(spark.range(9).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), "x", path)
    with pytest.raises(LayerError):
        sketches.add_partition(spark.range(9).withColumn("more", F.lit(1)), "x", path)
    zeros = scratch_path(spark, "zeros")
    sketches.add_partition(spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),)], "v double"), "x", zeros)
    row = sketches.merged_profile(spark, zeros).first()
    assert (row["n_distinct"], row["min_value"], row["max_value"], row["quartiles"]) == (2, "0.0", "NaN", [0.0, 0.0, 0.0])
    row = sketches.merged_profile(spark, path).first()
    assert (row["n_rows"], row["n_distinct"], row["min_value"], row["max_value"]) == (10, 10, "0", "9")
    with pytest.raises(LayerError):
        sketches.merged_profile(spark, scratch_path(spark, "none"))
