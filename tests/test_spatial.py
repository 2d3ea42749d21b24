"""Spatial joins against brute force, under skew and for every cell size."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import geom as G
from terravia.functions import shapes as S
from terravia.operators import first_hits, grid, nearest, spatial

FORCED = {"cell_work": 50, "rows_per_salt": 20}  # makes nearly every cell crowded


def _boxes(spark, n, seed, prefix=""):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all boxes are copies at one place
        x, y = (100.0, 100.0) if i % 3 == 0 else (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000))
        rows.append((i, x, y, x + rng.choice([0.0, 10.0, 400.0]), y + rng.choice([0.0, 20.0, 300.0])))
    names = ["id", "xmin", "ymin", "xmax", "ymax"]
    return spark.createDataFrame(rows, "id long, xmin double, ymin double, xmax double, ymax double").toDF(
        *[prefix + n for n in names]
    )


def _segments(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = (110.0, 90.0) if i % 3 == 0 else (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000))
        far = rng.choice([0.0, 30.0, 2500.0])
        rows.append((f"R{i % 7}", x, y, x + rng.uniform(-far, far), y + rng.uniform(-far, far)))
    return spark.createDataFrame(rows, "lib_rte string, x1 double, y1 double, x2 double, y2 double")


def _points(spark, n, seed, spread=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = (120.0, 100.0) if i % 3 == 0 else (float(rng.randint(-spread, spread)), float(rng.randint(-spread, spread)))
        rows.append((i, x, y))
    return spark.createDataFrame(rows, "gid long, x double, y double")


def _set(df):
    return sorted(map(tuple, df.collect()))


OTHER = S.Box("b_xmin", "b_ymin", "b_xmax", "b_ymax")


@pytest.mark.parametrize("cell,options", [(70.0, FORCED), (500.0, {"balance": False}), (9000.0, FORCED), (500.0, {})])
def test_box_join_equals_brute_force(spark, cell, options):
    a, b = _boxes(spark, 120, 1), _boxes(spark, 90, 2, "b_")
    brute = a.join(b).where(S.intersects(S.Box(), OTHER)).select("id", "b_id")
    found = spatial.intersects_join(a, S.Box(), b, OTHER, cell, **options).select("id", "b_id")
    assert _set(found) == _set(brute)  # also: no pair twice


@pytest.mark.parametrize("radius", [0.0, 700.0])
def test_box_distance_join_equals_brute_force(spark, radius):
    a, b = _boxes(spark, 100, 3), _boxes(spark, 80, 4, "b_")
    brute = a.join(b).where(S.within(S.Box(), OTHER, radius)).select("id", "b_id")
    found = spatial.within_distance_join(a, S.Box(), b, OTHER, radius, 300.0, **FORCED).select("id", "b_id")
    assert _set(found) == _set(brute)


@pytest.mark.parametrize("cell,options", [(120.0, FORCED), (1000.0, FORCED), (None, {})])
def test_buffer_join_equals_brute_force(spark, cell, options):
    parts = _segments(spark, 90, 5)
    for df, shape, key in ((_boxes(spark, 120, 6), S.Box(), "id"), (_points(spark, 300, 7), S.Point(), "gid")):
        brute = df.join(parts).where(S.distance2(shape, S.Segment()) <= 2500).select(key, "lib_rte").distinct()
        found = spatial.buffer_intersects_join(df, shape, key, parts, S.Segment(), "lib_rte", 50.0, cell, **options)
        assert _set(found) == _set(brute)


def test_points_on_cell_edges(spark):
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(
        [(0, 0), (100, 0), (-100, 100), (200, -200), (100, 100)])], "gid long, x double, y double")
    seg = spark.createDataFrame([("A", -100.0, 0.0, 200.0, 0.0)], "lib_rte string, x1 double, y1 double, x2 double, y2 double")
    found = spatial.buffer_intersects_join(pts, S.Point(), "gid", seg, S.Segment(), "lib_rte", 100.0, 100.0)
    assert _set(found) == [(0, "A"), (1, "A"), (2, "A"), (4, "A")]


def test_radius_edge(spark):
    pts = spark.createDataFrame([(1, 5.0, 50.0), (2, 5.0, 50.001)], "gid long, x double, y double")
    seg = spark.createDataFrame([("A", 0.0, 0.0, 10.0, 0.0)], "lib_rte string, x1 double, y1 double, x2 double, y2 double")
    found = spatial.buffer_intersects_join(pts, S.Point(), "gid", seg, S.Segment(), "lib_rte", 50.0, 200.0)
    assert _set(found) == [(1, "A")]


@pytest.mark.parametrize("options", [{}, FORCED])
def test_segments_on_the_left_equal_brute_force(spark, options):
    parts = _segments(spark, 90, 21).withColumn("k", F.monotonically_increasing_id()).coalesce(1)
    boxes = _boxes(spark, 90, 22)
    brute = parts.join(boxes).where(S.intersects(S.Segment(), S.Box())).select("k", "id")
    found = spatial.intersects_join(parts, S.Segment(), boxes, S.Box(), 150.0, **options).select("k", "id")
    assert _set(found) == _set(brute)


def test_result_does_not_depend_on_partitions(spark):
    a, b = _boxes(spark, 90, 1), _boxes(spark, 60, 2, "b_")
    one = spatial.intersects_join(a.coalesce(1), S.Box(), b.coalesce(1), OTHER, 200.0, **FORCED).select("id", "b_id")
    many = spatial.intersects_join(a.repartition(7), S.Box(), b.repartition(5), OTHER, 200.0, **FORCED).select("id", "b_id")
    assert _set(one) == _set(many)


def test_mixed_srids_are_refused_in_a_join(spark):
    a = spark.createDataFrame([(1, "POINT (1 1)")], "i int, w string").select("i", G.from_wkt(F.col("w"), 4326).alias("ga"))
    b = spark.createDataFrame([(1, "POINT (1 1)")], "j int, w string").select("j", G.from_wkt(F.col("w"), 2154).alias("gb"))
    with pytest.raises(PySparkException, match="mixed SRIDs"):
        spatial.geometry_pairs(a, "i", S.Geom("ga"), b, "j", S.Geom("gb"), cell=10.0).collect()


def test_touching_boxes_intersect(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "id long, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame(
        [(2, 1.0, 0.0, 2.0, 1.0), (3, 1.0, 1.0, 2.0, 2.0), (4, 1.5, 0.0, 2.0, 1.0)],
        "b_id long, b_xmin double, b_ymin double, b_xmax double, b_ymax double")
    assert _set(spatial.intersects_join(a, S.Box(), b, OTHER, 10.0).select("id", "b_id")) == [(1, 2), (1, 3)]


def test_general_geometries_equal_brute_force(spark):
    from tests.test_geometry import KEPT, _random_shapes

    left = spark.createDataFrame(list(enumerate(KEPT + _random_shapes(12, 8))), "i int, w string").select(
        "i", G.from_wkt(F.col("w")).alias("ga"))
    right = spark.createDataFrame(list(enumerate(KEPT + _random_shapes(12, 9))), "j int, w string").select(
        "j", G.from_wkt(F.col("w")).alias("gb"))
    for radius, options in ((0.0, {}), (2.5, FORCED)):
        brute = left.join(right).where(G.st_distance2(F.col("ga"), F.col("gb")) <= radius * radius).select("i", "j")
        found = spatial.geometry_pairs(left, "i", S.Geom("ga"), right, "j", S.Geom("gb"), radius, 6.0, **options)
        assert _set(found) == _set(brute)


def test_empty_inputs_keep_the_schema(spark):
    empty = _points(spark, 3, 1).where("false")
    parts = _segments(spark, 5, 1)
    found = spatial.buffer_intersects_join(empty, S.Point(), "gid", parts.where("false"), S.Segment(), "lib_rte")
    assert found.columns == ["gid", "lib_rte"] and found.count() == 0
    centres = _points(spark, 2, 2).withColumn("libcei", F.lit("A"))
    assert nearest.nearest_centre(empty, S.Point(), centres).columns == ["gid", "x", "y", "cgid", "libcei", "distance"]
    alone = nearest.nearest_centre(_points(spark, 3, 1), S.Point(), centres.where("false")).collect()
    assert [r.libcei for r in alone] == [None] * 3


def test_same_column_names_are_refused(spark):
    with pytest.raises(LayerError):
        spatial.intersects_join(_boxes(spark, 3, 1), S.Box(), _boxes(spark, 3, 2), S.Box(), 10.0)


def test_touch_flag_is_never_null(spark):
    """One row each, also where the key repeats or is NULL, and false without a geometry."""
    rows = [(1, 0.0, 0.0), (1, 9e5, 0.0), (None, 3.0, 0.0), (None, 9e5, 9.0), (4, None, 0.0), (5, 10.0, 0.0), (5, 10.0, 0.0)]
    df = spark.createDataFrame(rows, "gid long, x double, y double")
    parts = spark.createDataFrame([("A", 0.0, 0.0, 5.0, 0.0), ("B", 0.0, 0.0, 5.0, 0.0)], "lib_rte string, x1 double, y1 double, x2 double, y2 double")
    got = spatial.touch_flag(df, S.Point(), parts, S.Segment(), "lib_rte", 5.0).collect()
    want = [(*r, r[1] is not None and r[1] <= 10) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("options", [{}, FORCED, {"balance": False}])
@pytest.mark.parametrize("shape", ["box", "point", "segment", "geom"])
def test_radius_per_row_equals_brute_force(spark, shape, options):
    """Radii from nothing to a thousand times the cell, some missing, one below zero."""
    parts = _segments(spark, 60, 5).withColumn("n", F.monotonically_increasing_id() % 9)
    radii = F.when(F.col("n") == 0, None).when(F.col("n") == 1, -5.0).when(F.col("n") == 2, 0.0).when(F.col("n") == 3, 4000.0).otherwise(F.col("n") * 17.5)
    parts = parts.withColumn("radius", radii).drop("n")
    left, mine = {
        "box": lambda: (_boxes(spark, 80, 3), S.Box()),
        "point": lambda: (_points(spark, 80, 3).withColumnRenamed("gid", "id"), S.Point()),
        "segment": lambda: (_segments(spark, 80, 9).select(F.monotonically_increasing_id().alias("id"), *[F.col(c).alias("l" + c) for c in ("x1", "y1", "x2", "y2")]), S.Segment("lx1", "ly1", "lx2", "ly2")),
        "geom": lambda: (_boxes(spark, 40, 3).select("id", S.Box().geom().alias("geom")), S.Geom()),
    }[shape]()
    brute = left.join(parts).where((F.col("radius") >= 0) & (S.distance2(mine, S.Segment()) <= F.col("radius") * F.col("radius")))
    found = spatial.buffer_intersects_join(left, mine, "id", parts, S.Segment(), "lib_rte", "radius", 150.0, **options)
    assert _set(found) == _set(brute.select("id", "lib_rte", "radius").distinct())


def test_many_radii_make_one_plan(spark):
    parts = _segments(spark, 300, 5).withColumn("radius", F.monotonically_increasing_id() * 0.5)
    plan = spatial.buffer_intersects_join(_boxes(spark, 50, 3), S.Box(), "id", parts, S.Segment(), "lib_rte", "radius", 200.0, balance=False)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Inner") == 1 and "Union" not in text


@pytest.mark.parametrize("hits,a,b,expected", [(0, 2, 3, [False]), (6, 2, 3, [True]), (2, 2, 3, [False, True]), (0, 0, 3, [])])
def test_distinct_outcomes(spark, hits, a, b, expected):
    one = lambda n: spark.range(n).agg(F.count(F.lit(1)))
    got = spatial.distinct_outcomes(one(a), one(b), spark.range(hits)).collect()
    assert sorted(r[0] for r in got) == expected


def _brute_nearest(features, centres):
    c = centres.select(F.col("gid").alias("cgid"), "libcei", F.col("x").alias("cx"), F.col("y").alias("cy"))
    d2 = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2
    return (features.join(c).groupBy("gid").agg(F.min(F.struct(d2.alias("d2"), "cgid")).alias("b"))
            .select("gid", "b.cgid"))


@pytest.mark.parametrize("n_centres", [20, 700])
def test_nearest_equals_brute_force(spark, n_centres):
    features = _points(spark, 200, 11).union(spark.createDataFrame([(900, 1e7, -4e6)], "gid long, x double, y double"))
    centres = _points(spark, n_centres, 12, 500).withColumn("libcei", F.concat(F.lit("C"), "gid"))
    found = nearest.nearest_centre(features, S.Point(), centres)
    assert _set(found.select("gid", "cgid")) == _set(_brute_nearest(features, centres))


def test_nearest_descent_is_forced_on_deep_clusters(spark):
    """Two tight clusters far apart, with copies and near copies."""
    rng = random.Random(5)
    rows = [(i, 1e-3 * rng.random(), 1e-3 * rng.random()) for i in range(150)]
    rows += [(200 + i, 9e5 + rng.random(), 9e5) for i in range(150)] + [(500 + i, 7.0, 7.0) for i in range(100)]
    centres = spark.createDataFrame(rows, "gid long, x double, y double").withColumn("libcei", F.lit("L"))
    features = _points(spark, 60, 13, 900000)
    found = nearest.nearest_centre(features, S.Point(), centres)
    assert _set(found.select("gid", "cgid")) == _set(_brute_nearest(features, centres))


@pytest.mark.parametrize("per_salt", [4, 100_000])
def test_nearest_without_broadcast(spark, monkeypatch, per_salt):
    """Every level shuffled, with the hot cells (a third of the features is at one place) salted."""
    monkeypatch.setattr(nearest, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(nearest, "ROWS_PER_SALT", per_salt)
    features = _points(spark, 150, 31)
    centres = _points(spark, 300, 32).withColumn("libcei", F.lit("L"))
    found = nearest.nearest_centre(features, S.Point(), centres)
    assert _set(found.select("gid", "cgid")) == _set(_brute_nearest(features, centres))


def test_nearest_is_the_same_whatever_the_number_of_centres(spark):
    inf, nan = float("inf"), float("nan")
    f = spark.createDataFrame(
        [(1, 0.0, 0.0), (1, 100.0, 100.0), (None, 50.0, 50.0), (None, 99.0, 99.0), (2, nan, 0.0), (3, 0.0, inf), (4, None, 1.0), (5, 1.0, 1.0), (5, 1.0, 1.0)],
        "gid long, x double, y double")
    c = spark.createDataFrame(
        [(0, "a", 0.0, 0.0), (10, "b", 100.0, 100.0), (11, "c", nan, 3.0), (12, "d", inf, 0.0), (13, "e", -inf, nan), (14, "f", None, 0.0),
         (7, "g", 0.0, 0.0), (None, "h", 500.0, 500.0), (15, None, 60.0, 60.0)],
        "gid long, libcei string, x double, y double")
    got = [sorted(map(repr, nearest.nearest_centre(f, S.Point(), c, in_row_limit=n).collect())) for n in (0, 1, None)]
    assert got[0] == got[1] == got[2]
    assert len(got[0]) == 9
    rows = {(r.gid, r.x): r.cgid for r in nearest.nearest_centre(f, S.Point(), c).collect()}
    assert rows[1, 0.0] == 0 and rows[1, 100.0] == 10 and rows[None, 50.0] == 15 and rows[None, 99.0] == 10
    assert rows[3, 0.0] is None and rows[4, None] is None
    assert nearest.nearest_centre(f, S.Point(), c.where("gid = 11"), in_row_limit=0).where("cgid is not null").count() == 0


def test_nearest_of_lines_and_polygons_from_a_large_set(spark):
    centres = _points(spark, 120, 14).withColumn("libcei", F.lit("L"))
    parts = _segments(spark, 30, 15).withColumn("gid", F.monotonically_increasing_id())
    boxes = _boxes(spark, 30, 16).withColumnRenamed("id", "gid")
    for df, shape in ((parts, S.Segment()), (boxes.select("gid", S.Box().geom().alias("geom")), S.Geom())):
        c = centres.select(F.col("gid").alias("cgid"), F.col("x").alias("cx"), F.col("y").alias("cy"))
        d2 = S.distance2_to_xy(shape, F.col("cx"), F.col("cy"))
        brute = df.join(c).groupBy("gid").agg(F.sqrt(F.min(d2)).alias("d"))
        found = nearest.nearest_centre(df, shape, centres).select("gid", "distance")
        for (g, d), (h, e) in zip(_set(brute), _set(found)):
            assert g == h and d == pytest.approx(e, abs=1e-6)


def test_tie_takes_least_id(spark):
    f = spark.createDataFrame([(1, 0.0, 0.0)], "gid long, x double, y double")
    c = spark.createDataFrame([(2, "B", -3.0, 4.0), (1, "A", 3.0, 4.0)], "gid long, libcei string, x double, y double")
    for limit in (10, 0):
        r = nearest.nearest_centre(f, S.Point(), c, in_row_limit=limit).first()
        assert (r.cgid, r.libcei, r.distance) == (1, "A", 5.0)


def test_null_geometry_and_null_centre(spark):
    f = spark.createDataFrame([(1, None, 0.0), (2, 1.0, 1.0)], "gid long, x double, y double")
    c = spark.createDataFrame([(1, "A", None, 4.0), (2, "B", 3.0, 4.0)], "gid long, libcei string, x double, y double")
    for limit in (10, 0):
        rows = nearest.nearest_centre(f, S.Point(), c, in_row_limit=limit).orderBy("gid").collect()
        assert [r.libcei for r in rows] == [None, "B"]


def test_distance_matrix_up_to_a_radius(spark):
    f, c = _points(spark, 50, 1), _points(spark, 30, 2).withColumn("libcei", F.lit("A"))
    pairs = f.join(c.select(F.col("gid").alias("cgid"), F.col("x").alias("cx"), F.col("y").alias("cy")))
    d2 = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2
    expected = pairs.where(d2 <= 300.0**2).select("gid", "cgid")
    got = nearest.distance_matrix(f, S.Point(), c, 300.0)
    assert _set(got.select("gid", "cgid")) == _set(expected)
    plan = _plan(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rank_shares_equal_distances(spark):
    m = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0), (1, 3, 9.0), (1, 4, None)], "gid int, cgid int, distance double")
    assert [r["rank"] for r in nearest.rank_by_distance(m).orderBy("cgid").collect()] == [1, 1, 3, 4]


# -- plans -------------------------------------------------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_join_is_an_equi_join_without_cross_product(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spatial.intersects_join(_boxes(spark, 50, 1), S.Box(), _boxes(spark, 50, 2, "b_"), OTHER, 100.0)
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_small_nearest_needs_no_shuffle(spark):
    c = _points(spark, 20, 2).withColumn("libcei", F.lit("A"))
    plan = _plan(nearest.nearest_centre(_points(spark, 50, 1), S.Point(), c))
    assert "Exchange" not in plan and "Join" not in plan


def test_large_nearest_has_no_cross_product(spark):
    c = _points(spark, 400, 2).withColumn("libcei", F.lit("A"))
    plan = _plan(nearest.nearest_centre(_points(spark, 50, 1), S.Point(), c))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_crowded_cells_are_cut_and_salted(spark):
    a = grid.list_cells(_points(spark, 3000, 1), S.Point(), 1000.0)
    b = grid.list_cells(_segments(spark, 300, 2), S.Segment(), 1000.0, 50.0)
    crowded = grid.find_crowded(a, b, 1000.0, 50.0, cell_work=1000, rows_per_salt=100)
    assert crowded.count > 0
    hot = crowded.table.where("_cx = 0 and _cy = 0").first()
    assert hot["_lsalts"] >= 10 and hot["_rsalts"] >= 3 and hot["_cut"] > 1


def _largest_key(df, shape, other, other_shape, cell, **options):
    """Rows of the largest join key of either side."""
    seen = []
    join = type(df).join

    def spy(self, right, on=None, how=None):
        if isinstance(on, list) and "_ls" in on:
            seen.append([x.groupBy(*on).count().agg(F.max("count")).first()[0] for x in (self, right)])
        return join(self, right, on, how) if how else join(self, right, on)

    type(df).join = spy
    try:
        n = grid.grid_candidates(df, shape, other, other_shape, cell, **options).count()
    finally:
        type(df).join = join
    return n, seen


def test_equal_rows_on_the_right_are_dealt_too(spark):
    left = spark.range(50).select("id", (F.col("id") % 5).cast("double").alias("x"), F.lit(0.0).alias("y"))
    one = spark.range(40_000).select(*[F.lit(v).alias(c) for c, v in (("x1", 0.0), ("y1", 0.0), ("x2", 5.0), ("y2", 0.0))])
    n, seen = _largest_key(left, S.Point(), one, S.Segment(), 100.0, cell_work=10_000, rows_per_salt=100)
    assert n == 50 * 40_000
    assert seen and max(seen[0]) <= 2000


def test_a_large_shape_is_listed_in_few_cells(spark):
    box = spark.createDataFrame([(0.0, 0.0, 200_000.0, 200_000.0)], "b_xmin double, b_ymin double, b_xmax double, b_ymax double")
    assert grid.list_cells(box, OTHER, 200.0).count() <= grid.MOST_CELLS
    line = spark.createDataFrame([(0.0, 0.0, 800_000.0, 300_000.0)], "x1 double, y1 double, x2 double, y2 double")
    assert grid.list_cells(line, S.Segment(), 100.0).count() <= grid.MOST_CELLS
    small = _boxes(spark, 300, 4).union(_boxes(spark, 20, 5))
    both = box.withColumn("b_id", F.lit(1)).unionByName(_boxes(spark, 200, 6, "b_").withColumn("b_id", F.col("b_id").cast("int")), allowMissingColumns=True)
    got = spatial.intersects_join(small, S.Box(), both, OTHER, 50.0)
    brute = small.join(both, S.intersects(S.Box(), OTHER))
    assert got.count() == brute.count() > 0
    assert _set(got.select("id", "b_id")) == _set(brute.select("id", "b_id"))


def test_equal_rows_give_their_own_pairs(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0)] * 2, "id int, xmin double, ymin double, xmax double, ymax double")
    line = spark.createDataFrame([(-5.0, 1.0, 20.0, 3.0)] * 3, "x1 double, y1 double, x2 double, y2 double")
    assert spatial.intersects_join(boxes, S.Box(), line, S.Segment(), 2.0).count() == 6


def test_one_polygon_that_holds_all_points(spark):
    area = spark.createDataFrame([(1, 0.0, 0.0, 1000.0, 1000.0)], "a int, xmin double, ymin double, xmax double, ymax double")
    points = spark.range(5000).select("id", F.array().cast("array<int>").alias("_"), (F.col("id") % 997).cast("double").alias("px"), F.lit(5.0).alias("py"))
    areas = area.select("a", S.Box().geom().alias("geom"))
    pts = points.select("id", S.Point("px", "py").geom().alias("spot"))
    got = spatial.geometry_pairs(areas, "a", S.Geom(), pts, "id", S.Geom("spot"), cell=100.0)
    assert got.count() == 5000


def test_mixed_srids_are_refused_by_every_join(spark):
    a = spark.createDataFrame([("SRID=4326;POINT(1 2)",)], "t string").select(G.from_wkt(F.col("t")).alias("geom"))
    b = spark.createDataFrame([("POINT(1 2)",)], "t string").select(G.from_wkt(F.col("t")).alias("other"))
    for join in (
        lambda: spatial.intersects_join(a, S.Geom(), b, S.Geom("other"), 10.0),
        lambda: spatial.within_distance_join(a, S.Geom(), b, S.Geom("other"), 5.0, 10.0),
        lambda: nearest.nearest_centre(a, S.Geom(), spark.createDataFrame([(1, "c", 0.0, 0.0)], "gid int, libcei string, x double, y double")),
    ):
        with pytest.raises(PySparkException, match="SRID"):
            join().collect()


def test_a_box_and_a_segment_meet_in_one_cell(spark):
    """Each pair once, without telling pairs apart afterwards; on either side, with a radius, in cut cells and many cells."""
    boxes, lines = _boxes(spark, 120, 21), _segments(spark, 120, 22)
    brute = boxes.join(lines, S.within(S.Box(), S.Segment(), 30.0))
    boxes_of = [S.Box(), S.Segment()]
    want = brute.count()
    assert want > 0
    for options in ({}, {"cell_work": 50, "rows_per_salt": 5}):
        for cell in (40.0, 700.0):
            one = grid.grid_candidates(boxes, S.Box(), lines, S.Segment(), cell, 30.0, **options)
            two = grid.grid_candidates(lines, S.Segment(), boxes, S.Box(), cell, 30.0, **options)
            for found in (one, two):
                assert found.where(S.within(*boxes_of, 30.0)).count() == want


def test_general_geometries_are_compared_in_pieces(monkeypatch):
    import pyarrow as pa

    from terravia.functions import edge_pairs

    rng = np.random.default_rng(3)
    kind = pa.struct([("srid", pa.int32()), ("kind", pa.string()), ("dim", pa.int32()), (
        "parts", pa.list_(pa.struct([("ring", pa.int32()), ("pts", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))])))])

    def geoms(n, corners):
        made = []
        for i in range(n):
            pts = [{"x": float(x), "y": float(y)} for x, y in rng.integers(0, 40, (corners, 2))]
            made.append(None if i % 17 == 5 else {"srid": 1, "kind": "POLYGON" if corners > 2 else "LINESTRING", "dim": 2, "parts": [{"ring": 0, "pts": [*pts, *pts[: corners > 2]]}]})
        return pa.array(made, kind)

    a, b = geoms(300, 4), geoms(300, 2)
    whole = [edge_pairs.on_both(a, b, ("POLYGON",), *how).to_pylist() for how in ((edge_pairs.distance2, pa.float64()), (edge_pairs.intersects, pa.bool_()))]
    monkeypatch.setattr(edge_pairs, "PAIRS", 3)
    pieces = [edge_pairs.on_both(a, b, ("POLYGON",), *how).to_pylist() for how in ((edge_pairs.distance2, pa.float64()), (edge_pairs.intersects, pa.bool_()))]
    assert whole == pieces and whole[0][5] is None and whole[1][5] is None
    assert [None if d is None else d == 0 for d in whole[0]] == whole[1]
    assert 0 < sum(bool(v) for v in whole[1]) < 283


FIRST = {"dense": 0.0, "cell_pairs": 0.0}


@pytest.mark.parametrize("more", [{}, {"hit_work": 50, "rows_per_salt": 20}])
@pytest.mark.parametrize("kind", ["box", "point", "segment", "polygon"])
def test_first_hits_equal_brute_force(spark, monkeypatch, kind, more):
    """One hit of a row and a route is enough, and none is lost."""
    left, shape, key = {
        "box": (_boxes(spark, 150, 5), S.Box(), "id"),
        "point": (_points(spark, 150, 6), S.Point("x", "y"), "gid"),
        "segment": (_segments(spark, 150, 7).toDF("_r", "ax1", "ay1", "ax2", "ay2").withColumn("id", F.monotonically_increasing_id()),
                    S.Segment("ax1", "ay1", "ax2", "ay2"), "id"),
        "polygon": (_boxes(spark, 150, 5).select("id", S.Box().geom().alias("geom")), S.Geom(), "id"),
    }[kind]
    parts = _segments(spark, 200, 8).withColumn("lib_rte", F.expr("nullif(lib_rte, 'R3')")).cache()
    called = []
    search = first_hits._search
    monkeypatch.setattr(first_hits, "_search", lambda *a: called.append(1) or search(*a))
    found = spatial.buffer_intersects_join(left, shape, key, parts, S.Segment(), "lib_rte", 50.0, 400.0, **FIRST, **more)
    brute = left.join(parts).where(S.within(shape, S.Segment(), 50.0)).select(key, "lib_rte").distinct()
    both = [sorted(map(str, df.collect())) for df in (found, brute)]
    assert both[0] == both[1] and called


def test_first_hits_with_a_radius_per_part(spark):
    left, parts = _boxes(spark, 150, 5), _segments(spark, 200, 8).withColumn("r", F.expr("case lib_rte when 'R1' then null when 'R2' then 0.0 else 60.0 end")).cache()
    found = spatial.buffer_intersects_join(left, S.Box(), "id", parts, S.Segment(), "lib_rte", "r", 400.0, **FIRST, hit_work=50, rows_per_salt=20)
    brute = left.join(parts).where("r is not null").where(S.within(S.Box(), S.Segment(), F.col("r"))).select("id", "lib_rte", "r").distinct()
    assert _set(found) == _set(brute)


@pytest.mark.parametrize("radius, more", [("r", {"hit_work": 50, "rows_per_salt": 20}), (60.0, {})])
@pytest.mark.parametrize("keys", ["id", "nullif(id % 120, 7)"])
def test_rows_with_a_cell_of_their_own_are_found_once(spark, monkeypatch, keys, radius, more):
    """What dense cells find of rows with a key of their own is not shuffled again; wide rows and keys that repeat or are missing are as ever."""
    wide = spark.range(3).selectExpr("id + 1000 as id", "100d as xmin", "100d as ymin", "1700d + id as xmax", "900d as ymax")
    small = _boxes(spark, 300, 5)
    for left in (small, small.unionByName(wide)):
        left = left.withColumn("id", F.expr(keys))
        parts = _segments(spark, 200, 8).withColumns({"r": F.expr("case lib_rte when 'R1' then null when 'R2' then 0.0 else 60.0 end"), "lib_rte": F.expr("nullif(lib_rte, 'R3')")}).cache()
        found = spatial.buffer_intersects_join(left, S.Box(), "id", parts, S.Segment(), "lib_rte", radius, 400.0, **FIRST, **more)
        reach = F.col("r") if radius == "r" else F.lit(60.0)
        names = ["id", "lib_rte", *(["r"] if radius == "r" else [])]
        brute = left.join(parts).where(reach.isNotNull()).where(S.within(S.Box(), S.Segment(), reach)).select(*names).distinct()
        both = [sorted(map(str, df.collect())) for df in (found, brute)]
        assert both[0] == both[1]
    plan = spatial.buffer_intersects_join(small, S.Box(), "id", parts, S.Segment(), "lib_rte", radius, 400.0, **FIRST, **more)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Aggregate" not in plan


@pytest.mark.parametrize("more", [{}, {"hit_work": 50, "rows_per_salt": 20}])
def test_buffers_of_dense_rows_come_with_their_columns(spark, more):
    wide = spark.range(2).selectExpr("id", "100d as xmin", "100d as ymin", "1700d as xmax", "900d as ymax")
    left = _boxes(spark, 150, 5).unionByName(wide).selectExpr("id % 9 as id", "*").drop("id").selectExpr("pmod(hash(*), 9) as id", "*", "named_struct('a', xmin) as more")
    parts = _segments(spark, 200, 8).cache()
    for rows in (left, left.where("xmax < 1700")):
        found = spatial.attach_buffers(rows, S.Box(), parts, S.Segment(), "lib_rte", 60.0, 400.0, **FIRST, **more)
        brute = rows.withColumn("_row", F.monotonically_increasing_id()).join(parts).where(S.within(S.Box(), S.Segment(), F.lit(60.0)))
        brute = brute.select("_row", *rows.columns, "lib_rte").distinct().drop("_row")
        assert found.columns == brute.columns
        both = [sorted(map(str, df.collect())) for df in (found, brute)]
        assert both[0] == both[1] and both[0]
    assert "Join Inner" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_first_hits_leave_a_group_at_its_first_hit(monkeypatch):
    """Tests of a row grow with the groups, not with the parts that it meets."""
    tested = []
    within = first_hits._within
    monkeypatch.setattr(first_hits, "_within", lambda kind, mine, seg, r2: tested.append(len(r2)) or within(kind, mine, seg, r2))
    n, m = 100, 500
    mine = [np.zeros(n), np.zeros(n), np.full(n, 10.0), np.full(n, 10.0)]
    seg = [np.full(m, 5.0)] * 4
    row, part = first_hits.first_hits(S.Box, mine, seg, np.full(m, 1.0), np.arange(m) % 5)
    assert len(row) == n * 5 and sum(tested) == n * 5 and set(part % 5) == set(range(5))


def test_a_crowded_cell_is_cut_no_finer_than_its_shapes(spark):
    """Wide shapes in a crowded cell are dealt to salts, not copied to hundreds of fine cells."""
    wide = spark.range(400).selectExpr("id", "0d as xmin", "0d as ymin", "900d as xmax", "900d as ymax")
    other = _other_boxes(wide)
    listed = [grid.list_cells(d, s, 1000.0) for d, s in ((wide, S.Box()), (other, OTHER))]
    crowded = grid.find_crowded(*listed, 1000.0, 0.0, 1000, 100, S.Box(), OTHER)
    assert crowded.table.agg(F.max("_cut")).first()[0] == 1
    joined = spatial.intersects_join(wide, S.Box(), other, OTHER, 1000.0, cell_work=1000, rows_per_salt=100)
    assert joined.count() == 160_000


def _other_boxes(df):
    return df.toDF(*["b_" + c for c in df.columns])
