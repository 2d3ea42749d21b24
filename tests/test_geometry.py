"""Geometry expressions against an independent implementation and by hand."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from terravia.functions import crs, wkb
from terravia.functions import geom as G
from terravia.functions import planar
from terravia.functions import shapes as S

KEPT = [
    "POINT (3 4)",
    "POINT (0 0)",
    "LINESTRING (0 0, 10 0)",
    "LINESTRING (5 -5, 5 5, 20 5)",
    "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))",
    "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 7 3, 7 7, 3 7, 3 3))",
    "POLYGON ((10 0, 20 0, 20 10, 10 10, 10 0))",
    "POLYGON ((10 10, 20 10, 20 20, 10 20, 10 10))",
    "POLYGON ((4 4, 6 4, 6 6, 4 6, 4 4))",
    "MULTIPOINT (50 50, 5 5)",
    "MULTILINESTRING ((30 30, 40 40), (1 1, 2 1))",
    "MULTIPOLYGON (((0 0, 4 0, 0 4, 0 0)), ((30 0, 40 0, 40 10, 30 10, 30 0), (32 2, 38 2, 38 8, 32 8, 32 2)))",
    "POINT (35 5)",
]


def _random_shapes(n, seed):
    rng = random.Random(seed)
    point = lambda: f"{rng.randint(0, 30)} {rng.randint(0, 30)}"
    out = []
    for i in range(n):
        if i % 3 == 0:
            out.append(f"POINT ({point()})")
        elif i % 3 == 1:
            out.append("LINESTRING (" + ", ".join(point() for _ in range(rng.randint(2, 4))) + ")")
        else:
            a, b, c = point(), point(), point()
            ax, ay, bx, by, cx, cy = map(int, f"{a} {b} {c}".split())
            if (bx - ax) * (cy - ay) == (by - ay) * (cx - ax):
                c = f"{cx + 1} {cy + 7}"
                if (bx - ax) * (cy + 7 - ay) == (by - ay) * (cx + 1 - ax):
                    continue
            out.append(f"POLYGON (({a}, {b}, {c}, {a}))")
    return out


def _pairs(spark, left, right):
    a = spark.createDataFrame(list(enumerate(left)), "i int, wa string")
    b = spark.createDataFrame(list(enumerate(right)), "j int, wb string")
    return a.join(b).withColumns({"ga": G.from_wkt(F.col("wa")), "gb": G.from_wkt(F.col("wb"))})


@pytest.mark.parametrize("left,right", [(KEPT, KEPT), (_random_shapes(45, 1), _random_shapes(45, 2))])
def test_distance_and_intersects_against_jts(spark, left, right):
    reader = spark._jvm.org.locationtech.jts.io.WKTReader()
    rows = _pairs(spark, left, right).select(
        "wa", "wb", G.st_intersects(F.col("ga"), F.col("gb")).alias("meets"),
        G.st_distance(F.col("ga"), F.col("gb")).alias("d"),
    ).collect()
    assert len(rows) == len(left) * len(right)
    for r in rows:
        a, b = reader.read(r.wa), reader.read(r.wb)
        assert r.meets == a.intersects(b), r
        assert r.d == pytest.approx(a.distance(b), abs=1e-9), r


def test_wkt_round_trip_length_area(spark):
    reader = spark._jvm.org.locationtech.jts.io.WKTReader()
    df = spark.createDataFrame([(w,) for w in KEPT], "w string").withColumn("g", G.from_wkt(F.col("w")))
    for r in df.select("w", G.to_wkt(F.col("g")).alias("out"), G.st_area(F.col("g")).alias("area"),
                       G.st_length(F.col("g")).alias("length")).collect():
        same = reader.read(r.w)
        assert reader.read(r.out).equalsExact(same), r
        assert r.area == pytest.approx(same.getArea())
        assert r.length == pytest.approx(same.getLength())


def test_capsule_equals_round_buffer(spark):
    reader = spark._jvm.org.locationtech.jts.io.WKTReader()
    rows = [(0.0, 0.0, 100.0, 0.0), (5.0, 5.0, -30.0, 70.0), (1.0, 2.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    areas = df.select("*", G.st_area(G.capsule(*[F.col(c) for c in df.columns], 50.0)).alias("a")).collect()
    for r in areas:
        text = f"POINT ({r.x1} {r.y1})" if (r.x1, r.y1) == (r.x2, r.y2) else f"LINESTRING ({r.x1} {r.y1}, {r.x2} {r.y2})"
        assert r.a == pytest.approx(reader.read(text).buffer(50.0).getArea(), rel=1e-9)


def test_buffer_of_geometry_keeps_one_polygon_per_edge(spark):
    df = spark.createDataFrame([("LINESTRING (0 0, 10 0, 10 10)",)], "w string")
    r = df.select(G.st_buffer(G.from_wkt(F.col("w")), 5.0).alias("b")).select(
        "b.kind", F.size("b.parts").alias("n")).first()
    assert (r.kind, r.n) == ("MULTIPOLYGON", 2)


def test_closed_forms_equal_general_geometry(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        x, y, w, h = (rng.randint(0, 20) for _ in range(4))
        rows.append((float(x), float(y), float(x + w), float(y + h), *(float(rng.randint(-5, 30)) for _ in range(6))))
    cols = ["xmin", "ymin", "xmax", "ymax", "x1", "y1", "x2", "y2", "x", "y"]
    df = spark.createDataFrame(rows, ",".join(f"{c} double" for c in cols))
    for a, b in [(S.Point(), S.Segment()), (S.Point(), S.Box()), (S.Segment(), S.Box()), (S.Segment(), S.Segment("x", "y", "x1", "y2"))]:
        got = df.select(
            S.distance2(a, b).alias("d"), G.st_distance2(a.geom(), b.geom()).alias("e"),
            S.intersects(a, b).alias("i"), S.within(a, b, 3.5).alias("w"),
        ).collect()
        for r in got:
            assert r.d == pytest.approx(r.e, abs=1e-6), (a, b, r)
            assert r.i == (r.e == 0), (a, b, r)
            assert r.w == (r.e <= 3.5 * 3.5), (a, b, r)


def test_null_geometry_gives_null(spark):
    df = spark.sql("select cast(null as double) x, 1.0D y, 0.0D x1, 0.0D y1, 1.0D x2, 1.0D y2")
    r = df.select(
        S.distance2(S.Point(), S.Segment()).alias("a"), S.intersects(S.Point(), S.Segment()).alias("b"),
        G.st_distance(S.Point().geom(), S.Segment().geom()).alias("c"), S.within(S.Point(), S.Segment(), 9.0).alias("d"),
    ).first()
    assert tuple(r) == (None, None, None, None)


def test_unknown_wkt_is_null(spark):
    df = spark.createDataFrame([("CIRCLE (1 2)",), ("POINT EMPTY",), (None,)], "w string")
    assert [r[0] for r in df.select(G.from_wkt(F.col("w"))).collect()] == [None, None, None]


def test_wkb_big_endian_srid_and_z(spark):
    little = struct.pack("<BIdd", 1, 1, 3.0, 4.0)
    big = struct.pack(">BIIdddd", 0, 2, 2, 1.0, 2.0, 3.0, 4.0)
    ewkb = struct.pack("<BIiddd", 1, 1 | wkb.FLAG_SRID | wkb.FLAG_Z, 4326, 5.0, 6.0, 7.0)
    iso_z = struct.pack("<BIddd", 1, 1001, 8.0, 9.0, 1.0)
    df = spark.createDataFrame([(1, little), (2, big), (3, ewkb), (4, iso_z), (5, None)], "i int, b binary")
    rows = df.select("i", wkb.from_wkb(F.col("b")).alias("g")).select(
        "i", "g.srid", "g.dim", G.to_wkt(F.col("g")).alias("w")).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [
        (1, 2154, 2, "POINT (3.0 4.0)"), (2, 2154, 2, "LINESTRING (1.0 2.0, 3.0 4.0)"),
        (3, 4326, 3, "POINT (5.0 6.0)"), (4, 2154, 3, "POINT (8.0 9.0)"), (5, None, None, None),
    ]


def test_wkb_round_trip(spark):
    df = spark.createDataFrame([(w,) for w in KEPT], "w string").withColumn("g", G.from_wkt(F.col("w")))
    back = df.select(G.to_wkt(F.col("g")).alias("a"), G.to_wkt(wkb.from_wkb(wkb.to_wkb(F.col("g")))).alias("b"))
    assert back.where("a <> b or b is null").count() == 0


def test_geojson_kinds(spark):
    rows = [
        ("Point", "[1, 2]", "POINT (1.0 2.0)"),
        ("MultiPoint", "[[1,2],[3,4]]", "MULTIPOINT ((1.0 2.0), (3.0 4.0))"),
        ("LineString", "[[1,2],[3,4]]", "LINESTRING (1.0 2.0, 3.0 4.0)"),
        ("Polygon", "[[[0,0],[4,0],[0,4],[0,0]],[[1,1],[2,1],[1,2],[1,1]]]",
         "POLYGON ((0.0 0.0, 4.0 0.0, 0.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 1.0 2.0, 1.0 1.0))"),
        ("MultiPolygon", "[[[[0,0],[4,0],[0,4],[0,0]]],[[[9,9],[8,9],[9,8],[9,9]]]]",
         "MULTIPOLYGON (((0.0 0.0, 4.0 0.0, 0.0 4.0, 0.0 0.0)), ((9.0 9.0, 8.0 9.0, 9.0 8.0, 9.0 9.0)))"),
        ("GeometryCollection", "[]", None),
    ]
    df = spark.createDataFrame(rows, "k string, c string, w string")
    for r in df.select("w", G.to_wkt(G.from_geojson(F.col("k"), F.col("c"))).alias("out")).collect():
        assert r.out == r.w


def test_lambert93_control_points(spark):
    df = spark.createDataFrame([(3.0, 46.5), (1.0993, 49.4431)], "lon double, lat double")
    x, y = crs.lambert93(F.col("lon"), F.col("lat"))
    got = [tuple(round(v, 3) for v in r) for r in df.select(x, y).collect()]
    assert got == [(700000.0, 6600000.0), (562122.093, 6928734.087)]


def test_unknown_projection_is_an_error():
    with pytest.raises(ValueError):
        crs.check_pair(27572, 2154)
    with pytest.raises(ValueError):
        crs.check_pair(4326, 3857)


def test_segments_touching_and_collinear(spark):
    cases = [
        ((0, 0, 10, 0), (10, 0, 20, 0), True), ((0, 0, 10, 0), (11, 0, 20, 0), False),
        ((0, 0, 10, 0), (5, 0, 6, 0), True), ((0, 0, 10, 10), (5, 5, 5, 5), True),
        ((0, 0, 10, 10), (5, 6, 5, 6), False), ((0, 0, 10, 0), (5, 1, 5, 9), False),
    ]
    df = spark.createDataFrame(
        [(*map(float, a), *map(float, b), e) for a, b, e in cases],
        "a0 double,a1 double,a2 double,a3 double,b0 double,b1 double,b2 double,b3 double,e boolean",
    )
    a, b = ([F.col(f"{n}{i}") for i in range(4)] for n in "ab")
    assert df.where(planar.segments_meet(a, b) != F.col("e")).count() == 0
