"""Balanced tiles, files with a manifest, and joins that leave the stored layer where it lies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import shapes as S
from terravia.operators import layout, spatial, tiles
from terravia.session import scratch_path

BOXES = "id long, xmin double, ymin double, xmax double, ymax double"


def boxes(spark, n, seed, prefix=""):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third at one spot, a few without a place, one very large
        x, y = (500.0, 500.0) if i % 3 == 0 else (rng.uniform(0, 9000), rng.expovariate(1 / 800))
        size = 6000.0 if i == 7 else rng.choice([0.0, 5.0, 60.0])
        rows.append((i, None if i % 50 == 9 else x, y, x + size, y + size))
    return spark.createDataFrame(rows, BOXES).toDF(*[prefix + c for c in ("id", "xmin", "ymin", "xmax", "ymax")])


def segments(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, x := rng.uniform(0, 9000), y := rng.uniform(0, 3000), x + rng.uniform(-900, 900), y + rng.uniform(-900, 900)) for i in range(n)]
    return spark.createDataFrame(rows + rows[:5], "seg long, x1 double, y1 double, x2 double, y2 double")


def stored(spark, df, shape, **sizes):
    path = scratch_path(spark, "tiles")
    spark.sql("create schema if not exists tiled")
    table = "tiled.t" + path[-32:]
    tiles.write_tiles(df, shape, table, path, **sizes)
    return table, path


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 255, 256])
def test_position_equals_a_sorted_search(spark, n):
    cuts = sorted(random.Random(n).uniform(0, 10) for _ in range(n))
    values = [-1.0, 0.0, 5.0, 11.0, *cuts[:20]]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(tiles._position(tiles._literal(cuts, "array<double>"), n, F.col("v"))).collect()]
    assert got == np.searchsorted(cuts, values, side="right").tolist()


def test_tiles_are_balanced_and_complete(spark):
    df = boxes(spark, 3000, 1)
    table, path = stored(spark, df, S.Box(), tile_rows=100, buckets=8)
    assert rows_of(spark.table(table).drop("tile")) == rows_of(df)
    about = {r["tile"]: r for r in tiles.manifest(spark, path).collect()}
    assert sum(r["rows"] for r in about.values()) == 3000
    assert about[-1]["rows"] == 60 and about[-1]["_tx0"] is None
    # a third of all rows is one spot: dealt by hash to several tiles
    assert max(r["rows"] for t, r in about.items() if t >= 0) < 400
    with pytest.raises(LayerError):
        tiles.add_tiles(df.withColumn("tile", F.lit(1)), S.Box())


@pytest.mark.parametrize("radius", [0.0, 40.0, "r"])
def test_join_equals_the_plain_join(spark, radius):
    df = boxes(spark, 1500, 2)
    table, path = stored(spark, df, S.Box(), tile_rows=60, buckets=5)
    lines, areas = segments(spark, 80, 3).withColumn("r", (F.col("seg") % 4) * 30.0), boxes(spark, 70, 4, "b_").withColumn("r", F.lit(25.0))
    other = S.Box("b_xmin", "b_ymin", "b_xmax", "b_ymax")
    for right, shape in ((lines, S.Segment()), (areas, other)):
        got = tiles.tile_join(spark, table, path, S.Box(), right, shape, radius)
        if radius:
            want = spatial.within_distance_join(df, S.Box(), right, shape, radius)
        else:
            want = spatial.intersects_join(df, S.Box(), right, shape)
        assert rows_of(got.select(*want.columns)) == rows_of(want)
        assert got.count() > 50


def test_the_stored_layer_is_not_shuffled(spark):
    table, path = stored(spark, boxes(spark, 2000, 2), S.Box(), tile_rows=60, buckets=5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for right, shape in ((segments(spark, 80, 3), S.Segment()), (boxes(spark, 70, 4, "b_"), S.Box("b_xmin", "b_ymin", "b_xmax", "b_ymax"))):
            pairs = tiles.tile_join(spark, table, path, S.Box(), right, shape, 10.0)
            lines = pairs._jdf.queryExecution().executedPlan().toString().split("\n")
            (scan,) = [i for i, text in enumerate(lines) if "FileScan parquet" in text and table.split(".")[1] in text]
            assert "Bucketed: true" in lines[scan]
            # the operators above the scan: each the nearest earlier line that is indented less
            depth, above = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789")), []
            for text in reversed(lines[:scan]):
                mine = len(text) - len(text.lstrip(" :+-*()0123456789"))
                if mine < depth:
                    depth = mine
                    above.append(text)
            assert any("SortMergeJoin" in text for text in above)
            assert not any("Exchange" in text for text in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_empty_layers(spark):
    none = boxes(spark, 10, 1).limit(0)
    table, path = stored(spark, none, S.Box())
    assert tiles.tile_join(spark, table, path, S.Box(), segments(spark, 5, 1), S.Segment(), 10.0).count() == 0
    table, path = stored(spark, boxes(spark, 30, 1), S.Box())
    assert tiles.tile_join(spark, table, path, S.Box(), segments(spark, 5, 1).limit(0), S.Segment(), 10.0).count() == 0


def test_files_follow_the_curve_and_the_manifest(spark):
    df = boxes(spark, 4000, 6)
    path = scratch_path(spark, "files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_files(df, S.Box(), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    about = layout.manifest(spark, path).collect()
    assert len(about) > 3 and sum(r["rows"] for r in about) == 4000
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    window = (5000.0, 200.0, 5600.0, 700.0)
    got = layout.read_files(spark, path, S.Box(), *window)
    want = df.where("xmin <= 5600 and xmax >= 5000 and ymin <= 700 and ymax >= 200 and xmin is not null")
    assert rows_of(got) == rows_of(want)
    assert 0 < len(got.inputFiles()) < len(about)
    assert layout.read_files(spark, path, S.Box(), -9e9, 0.0, -8e9, 1.0).count() == 0
