"""Versions of a layer: what a failed, a repeated and a late run leave behind."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.session import scratch_path
from terravia.sources import versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_run_that_fails_in_mid_write_leaves_the_old_layer(spark):
    path = scratch_path(spark, "layer")
    versions.write_version(spark.range(50).select("id", F.lit("old").alias("v")), path)
    late = F.when(F.col("id") == 999, F.raise_error(F.lit("broken")).cast("string")).otherwise("new")
    with pytest.raises(PySparkException):
        versions.write_version(spark.range(0, 1000, 1, 8).select("id", late.alias("v")), path)
    assert rows(versions.read_version(spark, path)) == [(i, "old") for i in range(50)]
    versions.write_version(spark.range(3).select("id", F.lit("new").alias("v")), path)
    assert rows(versions.read_version(spark, path)) == [(i, "new") for i in range(3)]
    assert rows(versions.read_version(spark, path, 1)) == [(i, "old") for i in range(50)]


def test_a_reader_keeps_its_version_while_another_run_writes(spark):
    path = scratch_path(spark, "layer")
    held = versions.write_version(spark.range(5), path)
    # a layer may be made from itself
    again = versions.write_version(versions.read_version(spark, path).select((F.col("id") + 10).alias("id")), path)
    assert rows(held) == [(i,) for i in range(5)] and rows(again) == [(i + 10,) for i in range(5)]


def test_a_late_run_is_refused(spark):
    path = scratch_path(spark, "layer")
    versions.write_version(spark.range(1), path)
    versions.write_version(spark.range(2), path, base=1)
    with pytest.raises(LayerError, match="another run"):
        versions.write_version(spark.range(3), path, base=1)
    assert versions.read_version(spark, path).count() == 2


def test_old_versions_go_when_asked(spark):
    path = scratch_path(spark, "layer")
    for n in range(1, 6):
        versions.write_version(spark.range(n), path)
    assert versions.drop_old_versions(spark, path, keep=2) == [1, 2, 3]
    assert list(versions.versions(spark, path)) == [4, 5]
    assert versions.read_version(spark, path).count() == 5 and versions.read_version(spark, path, 4).count() == 4
    assert versions.drop_old_versions(spark, path, keep=0) == [4]
    assert versions.read_version(spark, path).count() == 5
    with pytest.raises(LayerError):
        versions.read_version(spark, path, 2)
    versions.write_version(spark.range(0), path)
    assert versions.read_version(spark, path).count() == 0


def test_no_versions(spark):
    path = scratch_path(spark, "layer")
    assert versions.versions(spark, path) == {}
    with pytest.raises(LayerError):
        versions.read_version(spark, path)
