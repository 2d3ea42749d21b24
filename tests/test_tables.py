"""Load, enrichment, quality, evolution, profile and job rules by hand."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import geom as G
from terravia.functions import shapes as S
from terravia.functions import text
from terravia.operators import dissolve, enrich, evolve, filters, joins, layout, load, profile, quality
from terravia.plans import jobs
from terravia.session import cut_lineage, scratch_path, shared_dir, use_all_cores
from terravia.sources import layers, sinks


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lowercase_collision(spark):
    with pytest.raises(LayerError):
        load.lowercase_fields(spark.createDataFrame([(1, 2)], "Nom int, NOM_ int").toDF("Nom", "NOM"))


def test_drop_string_length_of_a_saved_table(spark):
    spark.sql("create table if not exists limited(name varchar(3), code char(2)) using parquet")
    plain = load.drop_string_length(spark.table("limited"))
    assert [f.dataType.simpleString() for f in plain.schema] == ["string", "string"]
    assert not any(f.metadata for f in plain.schema)


@pytest.mark.parametrize("buckets", [1, 2, 7])
def test_dense_gid_is_dense_and_ordered(spark, buckets):
    df = spark.range(1000, 0, -3).select((F.col("id") * 7).alias("k")).repartition(5)
    got = load.assign_dense_gid(df, "k", buckets=buckets).orderBy("k").collect()
    assert [r.gid for r in got] == list(range(1, len(got) + 1))


def test_dense_gid_on_text_keys(spark):
    df = spark.range(300).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = load.assign_dense_gid(df, "k", buckets=4).orderBy("k").collect()
    assert [r.gid for r in got] == list(range(1, 301))


@pytest.mark.parametrize("buckets", [1, 6])
def test_dense_gid_with_a_hot_value_and_nulls(spark, buckets):
    k = F.when(F.col("id") % 3 == 0, F.lit(500)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id"))
    got = load.assign_dense_gid(spark.range(900).select("id", k.alias("k")), "k", buckets=buckets).collect()
    assert sorted(r.gid for r in got) == list(range(1, 901))
    in_order = [r.k for r in sorted(got, key=lambda r: r.gid)]
    known = [v for v in in_order if v is not None]
    assert known == sorted(known) and in_order[: len(known)] == known


def test_lookup_join_splits_hot_keys(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
                                 .otherwise(F.col("id")).alias("k"))
    table = spark.range(0, 400, 1).select(F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    plain = df.join(table, F.col("k") == F.col("t"), "left")
    for rows_per_salt in (10, 1, 1000):
        split = joins.lookup_join(df, F.col("k"), table, "t", broadcast_rows=10, rows_per_salt=rows_per_salt)
        assert split.columns == plain.columns
        assert _rows(split) == _rows(plain)


def test_lookups_without_broadcast_equal_the_broadcast_ones(spark, monkeypatch):
    """Hot, missing and unknown keys; a key with two rows still fails in the task that asks for it."""
    from terravia.operators import enrich

    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("K"), F.col("id"))).alias("k"), F.lit("old").alias("v"))
    source = spark.createDataFrame([("hot", "a"), ("K1", "b"), ("K4", None), ("two", "c"), ("two", "d")], "k string, v string")
    want = [_rows(enrich.update_from(df, source, "k", "v", "v")), _rows(enrich.lookup_value(df.drop("v"), source, "k", "k", "v", "w"))]
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(joins.lookup_join, "__defaults__", (joins.BROADCAST_ROWS, 7))
    assert [_rows(enrich.update_from(df, source, "k", "v", "v")), _rows(enrich.lookup_value(df.drop("v"), source, "k", "k", "v", "w"))] == want
    with pytest.raises(PySparkException):
        enrich.lookup_value(spark.createDataFrame([("two",)], "k string"), source, "k", "k", "v", "w").collect()


def test_domain_check_reports_null_and_require_domain_raises(spark):
    df = spark.createDataFrame([("a",), ("B",), ("x",), (None,)], "v string")
    domain = spark.createDataFrame([("A",), ("B",)], "d string")
    assert _rows(filters.domain_check(df, "v", domain, "d")) == [("x",), (None,)]
    with pytest.raises(LayerError, match="x"):
        filters.require_domain(df, "v", domain, "d")
    filters.require_domain(df.where("v in ('a', 'B')"), "v", domain, "d")


def test_missing_column_is_an_error(spark):
    df = spark.range(1)
    for call in (lambda: filters.distinct_values(df, "z"), lambda: evolve.drop_column(df, "z"),
                 lambda: evolve.rename_column(df, "z", "y"), lambda: evolve.set_type(df, "z", "int"),
                 lambda: quality.length_guard(df, "z"), lambda: filters.attribute_tag(df, "z", "t")):
        with pytest.raises(LayerError):
            call()


def test_capabilities(spark):
    g = spark.createDataFrame([(1, "SELECT"), (1, "DELETE"), (1, "SELECT"), (2, "SELECT")], "o int, p string")
    sets = filters.capability_sets(g, "o", "p", ["SELECT", "INSERT", "DELETE"])
    assert _rows(sets) == [(1, ["DELETE", "SELECT"]), (2, ["SELECT"])]
    assert [r.o for r in filters.with_capabilities(sets, ["DELETE", "SELECT"]).collect()] == [1]
    assert filters.with_capabilities(sets, []).count() == 2
    with pytest.raises(LayerError):
        filters.with_capabilities(sets, [], schema="x")


def test_update_from_keeps_unmatched_and_refuses_two_rows(spark):
    df = spark.createDataFrame([(1, "old"), (2, "old")], "gid int, v string")
    src = spark.createDataFrame([(1, "new"), (3, "new")], "gid int, w string")
    assert _rows(enrich.update_from(df, src, "gid", "v", "w")) == [(1, "new"), (2, "old")]
    with pytest.raises(PySparkException, match="several source rows"):
        enrich.update_from(df, src.union(src), "gid", "v", "w").collect()
    set_null = spark.createDataFrame([(1, None)], "gid int, w string")
    assert _rows(enrich.update_from(df, set_null, "gid", "v", "w")) == [(1, None), (2, "old")]


def test_lookup_two_rows_fail_only_when_asked(spark):
    lookup = spark.createDataFrame([("A", "D1"), ("A", "D2"), ("B", "D3")], "cei string, district string")
    df = spark.createDataFrame([("B",), ("b",), ("Z",), (None,)], "_cei string")
    found = enrich.lookup_value(df, lookup, "_cei", "cei", "district", "_district")
    assert _rows(found) == [("B", "D3"), ("Z", None), ("b", None), (None, None)]
    upper = enrich.lookup_value(df, lookup, "_cei", "cei", "district", "_district", normalise=True)
    assert _rows(upper) == [("B", "D3"), ("Z", None), ("b", "D3"), (None, None)]
    with pytest.raises(PySparkException, match="several lookup rows"):
        enrich.lookup_value(spark.createDataFrame([("A",)], "_cei string"), lookup, "_cei", "cei", "district", "d").collect()


def test_overlay_by_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    rich = spark.createDataFrame([(2, "B"), (1, None)], "k int, t string")
    assert _rows(enrich.overlay(base, rich, "k", ["t"])) == [(1, "a"), (2, "B")]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (2, "d")], "k int, v string")
    assert _rows(quality.check_primary_key(df, "k")) == [(1, 2), (None, 2)]
    assert _rows(quality.check_unique(df, "k")) == [(1, 2)]
    assert quality.check_not_null(df, ["k", "v"]).count() == 2
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert _rows(quality.check_foreign_key(df, "k", parent, "p")) == [(2, "d")]
    assert _rows(quality.check_predicate(df, F.col("k") < 2)) == [(2, "d")]
    assert quality.choose_key(df, "k").key == ("gid",) and "repeated" in quality.choose_key(df, "k").reason
    assert quality.choose_key(df, "nope").key == ("gid",)
    assert quality.choose_key(df, None) == quality.KeyChoice(("gid",), None)
    assert quality.choose_key(df.where("k = 2"), "k") == quality.KeyChoice(("k",), None)


def test_evolution_steps(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    steps = [
        (evolve.add_column, "c", "int", 7), (evolve.rename_column, "b", "label"), (evolve.set_type, "a", "bigint"),
        (evolve.set_default, "label", "none"),
    ]
    grown = evolve.append_rows(evolve.evolve(df, steps), spark.createDataFrame([(2,)], "a int"))
    assert _rows(grown) == [(1, "x", 7), (2, "none", None)]
    dropped = evolve.set_default(evolve.set_default(df, "b", "none"), "b", None)
    assert _rows(evolve.append_rows(dropped, spark.createDataFrame([(2,)], "a int"))) == [(1, "x"), (2, None)]
    with pytest.raises(LayerError):
        evolve.add_column(df, "a", "int")
    with pytest.raises(LayerError):
        evolve.append_rows(df, spark.createDataFrame([(2,)], "zz int"))
    with pytest.raises(PySparkException):
        evolve.set_type(df, "b", "int").collect()


def test_geometry_columns(spark):
    df = evolve.add_geometry_column(spark.range(1), "geom", "POINT", 2154)
    assert df.schema["geom"].metadata == {"kind": "POINT", "srid": 2154, "dim": 2}
    assert layers.has_geometry(df) and not layers.has_geometry(evolve.drop_geometry_column(df))
    with pytest.raises(LayerError):
        evolve.drop_geometry_column(df, "id")
    with pytest.raises(LayerError):
        evolve.add_geometry_column(spark.range(1), "geom", "BLOB")


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "k int, v string")
    exact = {r.column_name: tuple(r)[1:] for r in profile.column_profile(df, exact=True).collect()}
    assert exact == {"k": (3, 0, 2, "1", "2"), "v": (3, 1, 2, "a", "b")}
    rough = {r.column_name: tuple(r)[1:] for r in profile.column_profile(df).collect()}
    assert rough == exact
    empty = {r.column_name: tuple(r)[1:] for r in profile.column_profile(df.where("false"), exact=True).collect()}
    assert empty["k"] == (0, 0, 0, None, None)
    listed = profile.table_profile(spark, evolve.set_default(df, "v", "z"), "t").collect()
    assert [tuple(r) for r in listed] == [("t", 1, "k", "int", True, None), ("t", 2, "v", "string", True, "z")]


def test_mixed_srids_are_refused(spark):
    a = spark.createDataFrame([("POINT (1 1)",)], "w string").select(G.from_wkt(F.col("w"), 4326).alias("geom"))
    b = spark.createDataFrame([("POINT (1 1)",)], "w string").select(G.from_wkt(F.col("w"), 2154).alias("geom"))
    assert profile.require_same_srid(a, a).count() == 1
    with pytest.raises(PySparkException, match="mixed SRIDs"):
        profile.require_same_srid(a, b).collect()
    with pytest.raises(LayerError):
        profile.require_same_srid(a, a.union(b))


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [('PROJCS["RGF93 / Lambert-93",GEOGCS["x"]]', " My Layer ", "LAYER"), ("plain", "  ", "The Layer"), (None, None, "L")],
        "srs string, given string, layer string")
    got = df.select(text.extract_quoted_name(F.col("srs")), text.clean_layer_name(F.col("given"), F.col("layer"))).collect()
    assert [tuple(r) for r in got] == [('"RGF93 / Lambert-93"', "MyLayer"), ("plain", "thelayer"), ("Unknown", "l")]
    one = spark.range(1).select(
        text.split_int_list(F.lit("1 2 3")).alias("i"), text.decode_code(F.lit("c"), text.REFERENTIAL_ACTIONS).alias("a"),
        text.decode_code(F.lit("?"), text.REFERENTIAL_ACTIONS).alias("b"), text.vintage(2014).alias("y")).first()
    assert tuple(one) == ([1, 2, 3], "CASCADE", None, 2014)


def test_layer_names(spark):
    assert layers.require_kind("a/b/Commune_2014", ("commune",)) == "commune"
    assert layers.require_kind("PARCELLE_localisant", ("parcelle", "localisant")) == "parcelle"
    with pytest.raises(LayerError):
        layers.require_kind("commune/route", ("commune",))
    names = spark.createDataFrame([("x/COMMUNE",), ("x/other",), (None,)], "n string")
    ok, bad = layers.route_by_name(names, "n", ("commune",))
    assert ok.count() == 1 and bad.count() == 2
    both = spark.createDataFrame([("geo/commune_parcelle",)], "n string")
    ok, bad = layers.route_by_name(both, "n", ("parcelle", "localisant"))
    assert [r.kind for r in ok.collect()] == ["parcelle"] == [layers.require_kind("geo/commune_parcelle", ("parcelle", "localisant"))]
    assert sinks.catalog_name("0-store") == "s0_store"


def test_files_are_routed_by_their_name(spark):
    root = scratch_path(spark, "layers")
    spark.range(3).write.parquet(f"{root}/all/kind=a")
    df = layers.read_layer(spark, f"{root}/all", name_as="file").withColumn("file", F.replace("file", F.lit("part-"), F.lit("commune-")))
    ok, bad = layers.route_by_name(df, "file", ("commune",))
    assert ok.count() == 3 and bad.count() == 0


def test_write_read_and_refuse_overwrite(spark):
    path = scratch_path(spark, "t")
    sinks.write_layer(spark.range(3).toDF("a"), path)
    with pytest.raises(PySparkException):
        sinks.write_layer(spark.range(3).toDF("a"), path)
    assert sinks.write_layer(spark.range(5).toDF("a"), path, overwrite=True).count() == 5


def test_partition_rerun_replaces_only_its_partition(spark):
    path = scratch_path(spark, "t")
    sinks.write_partitions(spark.createDataFrame([(1, 2014), (2, 2015)], "a int, millesime int"), path, "millesime")
    sinks.write_partitions(spark.createDataFrame([(9, 2015)], "a int, millesime int"), path, "millesime")
    assert _rows(spark.read.parquet(path)) == [(1, 2014), (9, 2015)]


@pytest.mark.parametrize("code", ["01", "2A", "a=b/c %", None])
def test_partition_codes_keep_their_type(spark, code):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    got = sinks.write_partition(df, path, {"dep": code, "layer": "x"})
    assert _rows(got) == [(1, code, "x"), (2, code, "x")]
    assert _rows(sinks.read_partitions(spark, path, df.selectExpr("a", "'' as dep", "'' as layer").schema)) == _rows(got)


def test_empty_first_run_and_empty_rerun(spark):
    path = scratch_path(spark, "t")
    none = spark.createDataFrame([], "a int")
    assert sinks.write_partition(none, path, {"dep": "2A"}).count() == 0
    some = sinks.write_partition(spark.createDataFrame([(5,)], "a int"), path, {"dep": "2B"})
    assert _rows(some) == [(5, "2B")]
    assert _rows(sinks.write_partition(spark.createDataFrame([(7,)], "a int"), path, {"dep": "2A"})) == [(7, "2A")]
    assert sinks.write_partition(none, path, {"dep": "2A"}).count() == 0
    assert _rows(sinks.read_partitions(spark, path, some.schema)) == [(5, "2B")]
    with pytest.raises(PySparkException):
        sinks.write_partition(none, path, {"dep": "2A"}, overwrite=False)


def test_intersect_jobs_without_rows_leave_no_old_ones(spark):
    near = spark.createDataFrame([(1, 0.0, 0.0)], "gid int, x double, y double")
    far = spark.createDataFrame([(1, 9e5, 9e5)], "gid int, x double, y double")
    parts = spark.createDataFrame([("A", 0.0, 0.0, 1.0, 0.0, 50.0)], "lib_rte string, x1 double, y1 double, x2 double, y2 double, radius double")
    path = scratch_path(spark, "dep")
    run = lambda df, buffers: jobs.parcel_intersect(df, S.Point(), buffers, path, "parcelle", "01").collect()
    assert run(far, parts) == []
    (row,) = run(near, parts)
    assert (row.gid, row.lib_rte, row.radius, row.layer, row.dep) == (1, "A", 50.0, "parcelle", "01")
    assert run(far, parts) == []
    assert run(near, parts.limit(0)) == []


def test_one_run_replaces_all_its_partitions(spark):
    """Départements from a column, keys that repeat or are missing, and one that is left without rows."""
    schema = "gid int, x double, y double, dep string"
    parts = spark.createDataFrame([("A", 0.0, 0.0, 1.0, 0.0, 50.0), ("B", 0.0, 0.0, 1.0, 0.0, 200.0), ("C", 0.0, 0.0, 1.0, 0.0, None)],
                                  "lib_rte string, x1 double, y1 double, x2 double, y2 double, radius double")
    path = scratch_path(spark, "deps")

    def run(rows, **options):
        done = jobs.parcel_intersect(spark.createDataFrame(rows, schema), S.Point(), parts, path, "parcelle", **options)
        return sorted(map(repr, map(tuple, done.select("gid", "x", "lib_rte", "radius", "dep").collect())))

    first = [(1, 0.0, 0.0, "01"), (1, 9e5, 0.0, "01"), (None, 10.0, 0.0, "2A"), (2, 100.0, 0.0, "2A"), (3, 20.0, 0.0, None)]
    of_01 = [(1, 0.0, "A", 50.0, "01"), (1, 0.0, "B", 200.0, "01")]
    others = [(None, 10.0, "A", 50.0, "2A"), (None, 10.0, "B", 200.0, "2A"), (2, 100.0, "B", 200.0, "2A"), (3, 20.0, "A", 50.0, None), (3, 20.0, "B", 200.0, None)]
    assert run(first) == sorted(map(repr, of_01 + others))
    # 01 has no rows any more; 2A and the rows without a département are not part of the second run
    assert run([(1, 9e5, 0.0, "01")]) == sorted(map(repr, others))
    with pytest.raises(LayerError):
        run([(1, 0.0, 0.0, "2A")], overwrite=False)


def test_dense_gid_does_not_depend_on_the_layout(spark):
    rows = spark.range(4000).select((F.col("id") % 5).alias("k"), (F.col("id") * 7919 % 4000).alias("v"), F.lit("x").alias("t"))
    got = [
        _rows(load.assign_dense_gid(rows.repartition(n), "k", buckets=b)) for n, b in ((1, 1), (8, 3), (5, 2000), (3, None))
    ]
    assert got[0] == got[1] == got[2] == got[3]
    assert [r[0] for r in got[0]] == sorted(r[0] for r in got[0]) or len({r[0] for r in got[0]}) == 4000


def test_dense_gid_of_missing_keys_and_odd_columns(spark):
    rows = spark.range(50).select(F.lit(None).cast("int").alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    got = load.assign_dense_gid(rows, "k").collect()
    assert sorted(r.gid for r in got) == list(range(1, 51))
    plan = load.assign_dense_gid(spark.range(10).toDF("k"), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_overlay_refuses_a_repeated_richer_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    richer = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "w")], "k int, v string")
    with pytest.raises(PySparkException, match="several richer rows"):
        enrich.overlay(base, richer, "k", ["v"]).collect()
    assert _rows(enrich.overlay(base.where("k = 2"), richer, "k", ["v"])) == [(2, "b")]


def test_wkt_prefix_and_projection_by_row(spark):
    texts = ["SRID=4326;POINT(3 46.5)", "POINT(700000 6600000)", " srid = 2154 ; POINT (1 2)", None, "SRID=4326;junk"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    g = df.select("i", G.from_wkt(F.col("t")).alias("geom"))
    assert [r.s for r in g.select(F.col("geom.srid").alias("s")).collect()] == [4326, 2154, 2154, None, None]
    moved = load.reproject_layer(g)
    x = F.round(F.col("geom.parts")[0]["pts"][0]["x"], 3).alias("x")
    assert [tuple(r) for r in moved.select("geom.srid", x).collect()][:3] == [(2154, 700000.0), (2154, 700000.0), (2154, 1.0)]
    odd = df.limit(1).select(G.from_wkt(F.lit("SRID=3857;POINT(1 2)")).alias("geom"))
    with pytest.raises(PySparkException, match="no projection"):
        load.reproject_layer(odd).collect()


def test_profile_lists_all_srids(spark):
    df = spark.createDataFrame([("SRID=4326;POINT(1 2)",), ("POINT(1 2 3)",)], "t string").select(G.from_wkt(F.col("t")).alias("geom"))
    row = profile.geometry_profile({"l": (df, S.Geom())}).first()
    assert (row.srid, row.dim) == ("2154,4326", "2,3")


def test_box_read_finds_areas_that_begin_outside(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 50.0, 50.0), (2, 300.0, 300.0, 301.0, 301.0)], "id int, xmin double, ymin double, xmax double, ymax double")
    path = scratch_path(spark, "g")
    layout.write_grid(df, S.Box(), 10.0, path)
    assert 1 in [r.id for r in layout.read_box(spark, path, 40.0, 40.0, 45.0, 45.0).collect()]
    empty = scratch_path(spark, "g")
    layout.write_grid(df.limit(0), S.Box(), 10.0, empty)


def test_salted_join_splits_a_hot_key(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k long, t string")
    got = joins.salted_join(big, small, "k", rows_per_salt=100)
    assert _rows(got) == _rows(big.join(small, "k"))


def test_broadcast_is_measured_in_bytes(spark):
    assert joins.fits_broadcast(spark.range(10), 10)
    assert not joins.fits_broadcast(spark.range(11), 10)
    assert not joins.fits_broadcast(spark.range(2).select(F.repeat(F.lit("x"), 1000).alias("t")), 10, 500)


def test_saved_table_in_a_schema_with_an_odd_name(spark):
    layer = spark.range(4).toDF("a").withColumn("geom", G.make_point(F.col("a"), F.lit(0.0)))
    full = sinks.save_table(layer, "0-store", "cei", overwrite=True)
    assert "a" in spark.sql(f"describe extended {full} a").first()[1]
    assert full == "s0_store.cei" and spark.table(full).count() == 4


def test_jdbc_refuses_raw_geometry(spark):
    df = evolve.add_geometry_column(spark.range(1))
    with pytest.raises(LayerError):
        sinks.write_jdbc(df, "jdbc:none", "t")


def test_geojson_collection(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"nom": "A"}, "geometry": {"type": "Point", "coordinates": [3.0, 46.5]}},
        {"type": "Feature", "properties": {"nom": "B"}, "geometry": None}]}
    file = tmp_path / "l.geojson"
    file.write_text(json.dumps(doc, indent=1))
    df = layers.read_layer(spark, str(file), "geojson", schema="nom string", srid=4326)
    moved = load.reproject_layer(df, 4326)
    rows = moved.select("nom", "geom.srid", F.round(F.col("geom.parts")[0]["pts"][0]["x"], 3).alias("x")).orderBy("nom").collect()
    assert [tuple(r) for r in rows] == [("A", 2154, 700000.0), ("B", None, None)]


def test_dissolve_ignores_copies_reversals_and_nulls(spark):
    df = spark.createDataFrame(
        [("A", 0.0, 0.0, 3.0, 4.0), ("A", 3.0, 4.0, 0.0, 0.0), ("A", None, 0.0, 1.0, 1.0), ("B", 1.0, 1.0, 1.0, 1.0)],
        "lib_rte string, x1 double, y1 double, x2 double, y2 double")
    got = dissolve.route_summary(dissolve.dissolve_parts(df, "lib_rte"), "lib_rte")
    assert _rows(got.select("lib_rte", "n_parts", "length")) == [("A", 1, 5.0), ("B", 1, 0.0)]


def test_grid_layout_prunes_partitions(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") * 37 % 1000).cast("double").alias("x"), (F.col("id") * 91 % 1000).cast("double").alias("y"))
    path = scratch_path(spark, "g")
    stored = layout.write_grid(df, S.Point(), 10.0, path, coarse=10)
    near = layout.read_box(spark, path, 0.0, 0.0, 99.0, 99.0)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "coarse_x" in plan.split("PartitionFilters:")[1][:120]
    assert "GreaterThanOrEqual(cx" in plan
    assert near.where("x <= 99 and y <= 99").count() == df.where("x <= 99 and y <= 99").count()
    assert len({f.split("coarse_x=")[1].rsplit("/", 1)[0] for f in stored.inputFiles()}) == 100


def test_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "p")
    spark.createDataFrame([(1, "OWN")], "a int, gestionnaire string").write.parquet(path)
    plan = spark.read.parquet(path).where("gestionnaire = 'OWN'").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gestionnaire,OWN)" in plan


def test_jobs_need_a_field_or_a_geometry(spark):
    lookup = spark.createDataFrame([("A", "D1")], "cei string, district string")
    with pytest.raises(LayerError):
        jobs.tag_centre_and_district(spark.range(1).toDF("gid"), lookup)
    with pytest.raises(LayerError):
        jobs.tag_district(spark.range(1).toDF("gid"), lookup)


def test_tag_longer_than_its_column_is_an_error(spark):
    long = "x" * 41
    lookup = spark.createDataFrame([(long.upper(), "D1")], "cei string, district string")
    layer = spark.createDataFrame([(1, long)], "gid int, f string")
    with pytest.raises(PySparkException, match="too long"):
        jobs.tag_centre_and_district(layer, lookup, field="f").collect()


def test_import_falls_back_to_gid(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "ID int, Nom string")
    done = jobs.import_layer(df, "14-couche", scratch_path(spark, "i"), primary_key="id")
    assert done.key.key == ("gid",) and done.view == "s14_couche_view"
    assert spark.table(done.view).columns == ["id", "nom", "gid"]
    assert done.profile.first().n_rows == 2 and done.profile.first().kind is None


PART = "lib_rte string, x1 double, y1 double, x2 double, y2 double, radius double"


def test_jobs_refuse_a_wrong_layer_name(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "gid int, x double, y double")
    parts = spark.createDataFrame([("A", 0.0, 0.0, 1.0, 0.0, 50.0)], PART)
    with pytest.raises(LayerError):
        jobs.commune_intersect(df, S.Point(), parts, "/nowhere", "parcelle_14", 2014)
    with pytest.raises(LayerError):
        jobs.departement_flag(df, S.Point(), parts, "commune", "/nowhere")


def test_departement_flag_is_stored_and_published(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 9e5, 0.0)], "gid int, x double, y double")
    parts = spark.createDataFrame([("A", 0.0, 0.0, 1.0, 0.0, 50.0)], PART)
    done = jobs.departement_flag(df, S.Point(), parts, "departement", scratch_path(spark, "d"), flag="near")
    assert _rows(spark.table(done.view).select("gid", "near")) == [(1, True), (2, False)]
    assert _rows(spark.table(done.table).select("gid", "near")) == [(1, True), (2, False)]


def test_parcels_and_address_points_do_not_share_a_partition(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "gid int, x double, y double")
    parts = spark.createDataFrame([("A", 0.0, 0.0, 1.0, 0.0, 50.0)], PART)
    path = scratch_path(spark, "dep")
    for name in ("parcelle", "localisant", "parcelle"):
        jobs.parcel_intersect(df, S.Point(), parts, path, name, 14)
    assert _rows(spark.read.parquet(path).select("layer", "dep", "gid")) == [("localisant", 14, 1), ("parcelle", 14, 1)]
    with pytest.raises(PySparkException):
        jobs.parcel_intersect(df, S.Point(), parts, path, "parcelle", 14, overwrite=False)


def test_a_cluster_session_without_a_shared_folder_is_refused():
    from types import SimpleNamespace as Fake

    nothing = Fake(get=lambda *a: None)
    context = Fake(getConf=lambda: nothing, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(LayerError, match="spark.checkpoint.dir"):
        shared_dir(Fake(conf=nothing, sparkContext=context))


def test_session_helpers(spark):
    assert shared_dir(spark)
    assert cut_lineage(spark.range(7)).count() == 7
    few = use_all_cores(spark.range(10).coalesce(1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(10).repartition(8)
    assert use_all_cores(many) is many
