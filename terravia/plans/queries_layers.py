"""Sources, sinks, load operators and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravia.functions import geom as G
from terravia.functions import shapes as S
from terravia.functions import text
from terravia.functions.wkb import to_wkb
from terravia.operators import layout, load, profile, sketches
from terravia.plans.fixtures import table, view, with_views
from terravia.plans.registry import milli, milli_sql, query
from terravia.session import scratch_path
from terravia.sources import layers, sinks, versions

BOUNDS = ("xmin", "ymin", "xmax", "ymax")


def _described(df, key):
    g = F.col("geom")
    box = G.bounds(g)
    return df.select(
        F.col(key).cast("bigint").alias("gid"),
        g["kind"].alias("kind"),
        g["srid"].alias("srid"),
        *[b.alias(n) for n, b in zip(BOUNDS, box)],
    )


POINT_ORACLE = with_views("feat") + """
    select gid, 'POINT' as kind, 2154 as srid, x as xmin, y as ymin, x as xmax, y as ymax from feat"""
LINE_ORACLE = with_views("segment") + """
    select seg_id as gid, 'LINESTRING' as kind, 2154 as srid, least(x1, x2) as xmin, least(y1, y2) as ymin,
           greatest(x1, x2) as xmax, greatest(y1, y2) as ymax from segment"""
AREA_ORACLE = with_views("rect") + """
    select id as gid, 'POLYGON' as kind, 2154 as srid, xmin, ymin, xmax, ymax from rect"""


@query("layer_scan", POINT_ORACLE)
def layer_scan(spark, sf):
    """Points stored as plain x, y columns of a Parquet file."""
    path = scratch_path(spark, "layer-xy")
    view(spark, sf, "feat").write.parquet(path)
    return _described(layers.read_layer(spark, path, "parquet", "xy", ["x", "y"]), "gid")


@query("layer_scan_wkt", LINE_ORACLE)
def layer_scan_wkt(spark, sf):
    """Lines stored as WKT text in CSV."""
    path = scratch_path(spark, "layer-wkt")
    lines = view(spark, sf, "segment").select("seg_id", G.to_wkt(S.Segment().geom()).alias("shape"))
    lines.write.option("header", True).csv(path)
    return _described(
        layers.read_layer(spark, path, "csv", "wkt", "shape", schema="seg_id bigint, shape string"), "seg_id"
    )


@query("layer_scan_wkb", AREA_ORACLE)
def layer_scan_wkb(spark, sf):
    """Areas stored as WKB bytes in ORC."""
    path = scratch_path(spark, "layer-wkb")
    view(spark, sf, "rect").select("id", to_wkb(S.Box().geom()).alias("shape")).write.orc(path)
    return _described(layers.read_layer(spark, path, "orc", "wkb", "shape"), "id")


@query("layer_scan_geojson", LINE_ORACLE)
def layer_scan_geojson(spark, sf):
    """Lines stored as GeoJSON, one feature per line."""
    path = scratch_path(spark, "layer-geojson")
    pair = lambda x, y: F.array(F.col(x), F.col(y))
    view(spark, sf, "segment").select(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("LineString").alias("type"), F.array(pair("x1", "y1"), pair("x2", "y2")).alias("coordinates")
        ).alias("geometry"),
        F.struct("seg_id").alias("properties"),
    ).write.json(path)
    read = layers.read_layer(spark, path, "geojson", schema="seg_id bigint", srid=2154, lines=True)
    return _described(read, "seg_id")


@query("layer_write_overwrite", with_views("feat") + " select gid, x, y from feat where gid % 2 = 0")
def layer_write_overwrite(spark, sf):
    """Write a layer, then replace it and read the replacement."""
    path = scratch_path(spark, "layer")
    feat = view(spark, sf, "feat")
    sinks.write_layer(feat, path)
    return sinks.write_layer(feat.where(F.col("gid") % 2 == 0), path, overwrite=True)


@query(
    "layer_write_versioned",
    with_views("feat") + " select gid, x, y, 1 as version from feat union all select gid, x, y, 2 from feat where gid % 2 = 0",
)
def layer_write_versioned(spark, sf):
    """Write a layer, make a second version of it from the first, and read both."""
    path = scratch_path(spark, "layer")
    versions.write_version(view(spark, sf, "feat"), path)
    versions.write_version(versions.read_version(spark, path).where(F.col("gid") % 2 == 0), path)
    first, current = versions.read_version(spark, path, 1), versions.read_version(spark, path)
    return first.withColumn("version", F.lit(1)).unionByName(current.withColumn("version", F.lit(2)))


@query("lowercase_fields", "select * from customer")
def lowercase_fields(spark, sf):
    customer = table(spark, sf, "customer")
    mixed = [c.upper() if i % 2 else c.title() for i, c in enumerate(customer.columns)]
    return load.lowercase_fields(customer.toDF(*mixed))


@query("drop_string_length", "select * from customer")
def drop_string_length(spark, sf):
    customer = table(spark, sf, "customer")
    limited = customer
    for i, c in enumerate(c for c, t in customer.dtypes if t == "string"):
        # the field metadata under which Spark keeps the declared length of a table column
        limited = limited.withMetadata(c, {load.DECLARED_LENGTH: f"varchar({40 + i})"})
    plain = load.drop_string_length(limited)
    assert any(f.metadata for f in limited.schema) and not any(f.metadata for f in plain.schema)
    return plain


@query("geometryless_import", "select * from supplier")
def geometryless_import(spark, sf):
    """A layer whose geometry is switched off keeps its attributes only."""
    supplier = table(spark, sf, "supplier").withColumns(
        {"x": F.col("s_suppkey").cast("double"), "y": F.lit(0.0)}
    )
    plain = layers.with_geometry(supplier, None, ["x", "y"])
    return sinks.write_layer(plain, scratch_path(spark, "attributes"))


@query("assign_gid", "select row_number() over (order by c_custkey) as gid, c_custkey, c_name from customer")
def assign_gid(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return load.assign_dense_gid(customer, "c_custkey", buckets=8)


@query("assign_gid_sparse", "select count(*) as n_rows, count(*) as n_keys from lineitem")
def assign_gid_sparse(spark, sf):
    """The shuffle-free key: unique, not dense."""
    keyed = load.assign_gid(table(spark, sf, "lineitem").select("l_orderkey"))
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("gid").alias("n_keys"))


def _lambert_sql():
    slant = "0.08181919104281579 * sin(radians(lat))"
    rho = (
        "11754255.426096004 * pow(tan(pi() / 4 - radians(lat) / 2) / "
        f"pow((1 - {slant}) / (1 + {slant}), 0.08181919104281579 / 2), 0.7256077650532695)"
    )
    theta = "0.7256077650532695 * radians(lon - 3)"
    x = f"700000 + ({rho}) * sin({theta})"
    y = f"6600000 + 6055612.049875985 - ({rho}) * cos({theta})"
    return x, y


LAMBERT_X, LAMBERT_Y = _lambert_sql()


@query(
    "reproject_l93",
    with_views("lonlat") + f" select gid, {milli_sql(LAMBERT_X)} as x, {milli_sql(LAMBERT_Y)} as y from lonlat",
)
def reproject_l93(spark, sf):
    moved = load.reproject_lonlat(view(spark, sf, "lonlat"), "lon", "lat")
    return moved.select("gid", milli(F.col("x")).alias("x"), milli(F.col("y")).alias("y"))


@query(
    "reproject_l93_layer",
    with_views("lonlat") + f" select gid, 2154 as srid, {milli_sql(LAMBERT_X)} as x, {milli_sql(LAMBERT_Y)} as y from lonlat",
)
def reproject_l93_layer(spark, sf):
    """The same projection applied to a geometry column."""
    layer = layers.with_geometry(view(spark, sf, "lonlat"), "xy", ["lon", "lat"], srid=4326)
    moved = load.reproject_layer(layer, 4326)
    x, y, *_ = G.bounds(F.col("geom"))
    return moved.select("gid", F.col("geom.srid").alias("srid"), milli(x).alias("x"), milli(y).alias("y"))


@query("publish_view", with_views("feat") + " select gid, x, y from feat")
def publish_view(spark, sf):
    return spark.table(sinks.publish_view(view(spark, sf, "feat"), "0-store feat"))


KIND_SQL = """
    case when last like '%commune%' then 'commune' when last like '%departement%' then 'departement'
         when last like '%parcelle%' then 'parcelle' when last like '%localisant%' then 'localisant' end"""


@query(
    "route_by_name",
    with_views("layer_name") + f""", cut as (
        select page_id, lower(split_part(name, '/', -1)) as last from layer_name)
    select page_id, coalesce({KIND_SQL}, 'error') as kind from cut""",
)
def route_by_name(spark, sf):
    accepted, quarantined = layers.route_by_name(view(spark, sf, "layer_name"), "name")
    wrong = quarantined.withColumn("kind", F.lit("error"))
    return accepted.unionByName(wrong).select("page_id", "kind")


@query(
    "vintage_partition",
    """select cast(extract(year from o_orderdate) as int) as millesime, cast(14 + o_orderkey % 4 as int) as dep,
              count(*) as n, sum(o_orderkey)::bigint as key_sum
       from orders group by 1, 2""",
)
def vintage_partition(spark, sf):
    """Partitions by vintage and département; one vintage is written twice and stays single."""
    path = scratch_path(spark, "vintage")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("millesime"),
        (14 + F.col("o_orderkey") % 4).cast("int").alias("dep"),
    )
    sinks.write_partitions(orders, path, ["millesime", "dep"])
    sinks.write_partitions(orders.where("millesime = 1997"), path, ["millesime", "dep"])
    sinks.write_partition(orders.where("millesime = 1998 and dep = 14"), path, {"millesime": 1998, "dep": 14})
    stored = sinks.read_partitions(spark, path, orders.schema)
    return stored.groupBy("millesime", "dep").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query("select_features", "select c_custkey, c_name from customer where c_acctbal < 0")
def select_features(spark, sf):
    customer = table(spark, sf, "customer")
    chosen = customer.where("c_acctbal < 0").select("c_custkey")
    return load.select_features(customer.select("c_custkey", "c_name"), chosen, "c_custkey")


@query(
    "clean_layer_name",
    """select p_partkey, replace(coalesce(nullif(trim(case when p_partkey % 3 = 0 then '  ' else p_name end), ''),
                                          lower(p_brand)), ' ', '') as name from part""",
)
def clean_layer_name(spark, sf):
    given = F.when(F.col("p_partkey") % 3 == 0, F.lit("  ")).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select(
        "p_partkey", text.clean_layer_name(given, F.col("p_brand")).alias("name")
    )


@query(
    "extract_quoted_name",
    """select event_id, case when event_id % 7 = 0 then 'Unknown'
                             when event_id % 7 = 1 then event_type
                             else regexp_extract(props, '"[^"]+"') end as name from events""",
)
def extract_quoted_name(spark, sf):
    source = (
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(F.col("event_id") % 7 == 1, F.col("event_type"))
        .otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", text.extract_quoted_name(source).alias("name"))


@query(
    "split_int_list",
    """select p_partkey, 3 as n, p_size + cast(p_partkey % 5 as int) + 7 as total from part""",
)
def split_int_list(spark, sf):
    joined = F.concat_ws(" ", F.col("p_size"), F.col("p_partkey") % 5, F.lit(7))
    numbers = text.split_int_list(joined)
    return table(spark, sf, "part").select(
        "p_partkey",
        F.size(numbers).alias("n"),
        F.aggregate(numbers, F.lit(0), lambda a, b: a + b).alias("total"),
    )


@query("join_list", "select p_partkey, concat_ws(' ', p_size, p_partkey % 5) as keys from part")
def join_list(spark, sf):
    items = F.array(F.col("p_size").cast("string"), (F.col("p_partkey") % 5).cast("string"))
    return table(spark, sf, "part").select("p_partkey", text.join_list(items).alias("keys"))


@query(
    "decode_code",
    """select o_orderkey,
              case lower(o_orderstatus) when 'f' then 'FOREIGN KEY' when 'p' then 'PRIMARY KEY' end as kind,
              case lower(o_orderstatus) when 'f' then 'FULL' when 'p' then 'PARTIAL' end as match_kind,
              case o_orderkey % 6 when 0 then 'NO ACTION' when 1 then 'RESTRICT' when 2 then 'CASCADE' when 3 then 'SET NULL'
                                  when 4 then 'SET DEFAULT' end as action,
              o_orderstatus = 'O' as unknown
       from orders""",
)
def decode_code(spark, sf):
    """Codes without a label (status O here) give NULL and are reported."""
    code = F.lower("o_orderstatus")
    kind = text.decode_code(code, text.CONSTRAINT_KINDS)
    action = F.substr(F.lit("arcndx"), (F.col("o_orderkey") % 6 + 1).cast("int"), F.lit(1))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        kind.alias("kind"),
        text.decode_code(code, text.MATCH_KINDS).alias("match_kind"),
        text.decode_code(action, text.REFERENTIAL_ACTIONS).alias("action"),
        kind.isNull().alias("unknown"),
    )


@query(
    "year_default",
    """select o_orderkey, cast(extract(year from current_date) as int) as millesime,
              concat('commune_', cast(extract(year from o_orderdate) as varchar)) as layer
       from orders""",
)
def year_default(spark, sf):
    named = F.concat(F.lit("commune_"), F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", text.vintage().alias("millesime"), named.alias("layer"))


@query(
    "grid_layout",
    with_views("feat") + """
    select gid, x, y from feat where x between 420000 and 455000 and y between 6860000 and 6905000""",
)
def grid_layout(spark, sf):
    """Write clustered by cell, then read a box through the partition filter."""
    path = scratch_path(spark, "grid")
    layout.write_grid(view(spark, sf, "feat"), S.Point(), 1000.0, path)
    near = layout.read_box(spark, path, 420000.0, 6860000.0, 455000.0, 6905000.0)
    exact = F.col("x").between(420000, 455000) & F.col("y").between(6860000, 6905000)
    return near.where(exact).select("gid", "x", "y")


@query(
    "grid_layout_area",
    with_views("rect") + """
    select id, xmin, ymin, xmax, ymax from rect
    where xmin <= 425000 and xmax >= 424900 and ymin <= 6880000 and ymax >= 6870000""",
)
def grid_layout_area(spark, sf):
    """Areas that meet a box, most of them with their lower left corner outside it."""
    path = scratch_path(spark, "grid")
    layout.write_grid(view(spark, sf, "rect"), S.Box(), 500.0, path)
    near = layout.read_box(spark, path, 424900.0, 6870000.0, 425000.0, 6880000.0)
    meets = (F.col("xmin") <= 425000) & (F.col("xmax") >= 424900) & (F.col("ymin") <= 6880000) & (F.col("ymax") >= 6870000)
    return near.where(meets).select("id", *BOUNDS)


PROFILED = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _profile_sql():
    return " union all ".join(
        f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, "
        f"count(distinct {c}) as n_distinct, cast(min({c}) as varchar) as min_value, "
        f"cast(max({c}) as varchar) as max_value from lineitem"
        for c in PROFILED
    )


@query("column_profile", _profile_sql())
def column_profile(spark, sf):
    """Every column of the table."""
    return profile.column_profile(table(spark, sf, "lineitem"), exact=True)


def _merged_sql():
    # a zero is 0.0 whatever its sign
    value = {c: f"{c} + 0.0" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    return " union all ".join(
        f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, "
        f"cast(min({value.get(c, c)}) as varchar) as min_value, cast(max({value.get(c, c)}) as varchar) as max_value, "
        "true as distinct_close, true as quartiles_close from lineitem"
        for c in PROFILED
    )


@query("column_profile_merged", _merged_sql())
def column_profile_merged(spark, sf):
    """A profile merged from the sketches of three partitions, one of them loaded twice, and whether its estimates hold."""
    lineitem, path = table(spark, sf, "lineitem"), scratch_path(spark, "sketches")
    sketches.add_partition(lineitem.where("l_linenumber > 2"), "late", path)
    sketches.add_partition(lineitem.where("l_linenumber <= 2 or l_linenumber is null"), "early", path)
    sketches.add_partition(lineitem.where("l_linenumber in (3, 4)"), "middle", path)
    sketches.add_partition(lineitem.where("l_linenumber > 4"), "late", path)
    merged = sketches.merged_profile(spark, path)
    # the estimates are a few numbers a column; one pass counts the rows at or below each
    estimates = {r["column_name"]: r["quartiles"] for r in merged.select("column_name", "quartiles").collect()}
    ranks = []
    for name, quartiles in estimates.items():
        column, close = sketches.as_number(lineitem.schema[name], F.col(name)), F.lit(True)
        for q, share in zip(quartiles or (), sketches.QUARTERS if quartiles else (), strict=True):
            close &= (F.count_if(column < q) <= (share + 0.02) * F.count(column)) & (F.count_if(column <= q) >= (share - 0.02) * F.count(column))
        ranks.append(F.struct(F.lit(name).alias("column_name"), close.alias("quartiles_close")))
    held = lineitem.agg(F.array(*ranks).alias("r")).select(F.inline("r"))
    exact = profile.column_profile(lineitem, exact=True).select("column_name", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.04)
    return merged.join(held, "column_name").join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", "min_value", "max_value", near.alias("distinct_close"), "quartiles_close"
    )


@query(
    "table_profile",
    """with listed as (select column_name, column_type, "null" as nulls, row_number() over () as position
                       from (describe lineitem)),
    counted as (""" + " union all ".join(f"select '{c}' as column_name, count({c}) as filled from lineitem" for c in PROFILED)
    + """)
    select 'lineitem' as table_name, cast(position as int) as position, column_name,
           case column_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' else lower(column_type) end as data_type,
           nulls = 'YES' as nullable, filled
    from listed join counted using (column_name)""",
)
def table_profile(spark, sf):
    """The ordered column list with the number of filled rows per column."""
    lineitem = table(spark, sf, "lineitem")
    listed = profile.table_profile(spark, lineitem, "lineitem").drop("default_value")
    counted = profile.column_profile(lineitem).select("column_name", (F.col("n_rows") - F.col("n_nulls")).alias("filled"))
    return listed.join(counted, "column_name").withColumn("data_type", F.replace("data_type", F.lit("_ntz"), F.lit("")))


@query(
    "geometry_profile",
    with_views("feat", "segment", "rect", "lookup") + """
    select 'feat' as layer, count(*) as n_rows, 'POINT' as kind, '2' as dim, '2154' as srid, 0 as n_missing,
           min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from feat
    union all
    select 'segment', count(*), 'LINESTRING', '2', '2154', 0, min(least(x1, x2)), min(least(y1, y2)),
           max(greatest(x1, x2)), max(greatest(y1, y2)) from segment
    union all
    select 'rect', count(*), 'POLYGON', '2', '2154', 0, min(xmin), min(ymin), max(xmax), max(ymax) from rect
    union all
    select 'lookup', count(*), null, null, null, null, null, null, null, null from lookup""",
)
def geometry_profile(spark, sf):
    rect = layers.with_geometry(view(spark, sf, "rect"), "box", list(BOUNDS))
    return profile.geometry_profile(
        {
            "feat": (view(spark, sf, "feat"), S.Point()),
            "segment": (view(spark, sf, "segment"), S.Segment()),
            "rect": (rect, S.Geom()),
            "lookup": (view(spark, sf, "lookup"), None),
        }
    )
