"""Spatial joins, distances, routes and geometry functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravia.functions import geom as G
from terravia.functions import shapes as S
from terravia.operators import dissolve, nearest, nearest_shapes, spatial, tiles
from terravia.plans import oracle_sql as sql
from terravia.plans.fixtures import layer, view, with_views
from terravia.plans.registry import milli, milli_sql, query
from terravia.session import scratch_path

CELL = 2000.0
D2_CENTRE = sql.point_point("f.x", "f.y", "c.x", "c.y")
RADIUS = 25000.0
MATRIX_SQL = f"""matrix as (
    select f.gid, c.gid as cgid, libcei, {D2_CENTRE} as d2 from feat f, centre c)"""
NEAR_SQL = f"""{MATRIX_SQL}, near as (select * from matrix where d2 <= {RADIUS * RADIUS})"""
NEAREST_SQL = f"""{MATRIX_SQL}, ranked as (
    select *, row_number() over (partition by gid order by d2, cgid) as rn from matrix)"""


@query(
    "distance_matrix",
    with_views("feat", "centre") + f", {NEAR_SQL} select gid, cgid, libcei, {milli_sql('sqrt(d2)')} as distance from near",
)
def distance_matrix(spark, sf):
    """Distances to all centres within 25 km."""
    matrix = nearest.distance_matrix(view(spark, sf, "feat"), S.Point(), view(spark, sf, "centre"), RADIUS)
    return matrix.withColumn("distance", milli(F.col("distance")))


@query(
    "nearest_centre",
    with_views("feat", "centre") + f""", {NEAREST_SQL}
    select gid, cgid, libcei, {milli_sql('sqrt(d2)')} as distance from ranked where rn = 1""",
)
def nearest_centre(spark, sf):
    found = nearest.nearest_centre(view(spark, sf, "feat"), S.Point(), view(spark, sf, "centre"))
    return found.select("gid", "cgid", "libcei", milli(F.col("distance")).alias("distance"))


@query(
    "nearest_centre_many",
    with_views("feat", "parcel") + f""", spot as (
        select id as cgid, xmin as px, ymin as py from parcel),
    best as (select gid, min({{'d2': {sql.point_point('x', 'y', 'px', 'py')}, 'cgid': cgid}}) as b from feat, spot group by gid)
    select gid, b.cgid as cgid, cast(b.cgid as varchar) as libcei, {milli_sql('sqrt(b.d2)')} as distance from best""",
)
def nearest_centre_many(spark, sf):
    """A large centre set (a corner of every parcel): found by descending through nested cells."""
    spots = view(spark, sf, "parcel").select("id", F.col("id").cast("string").alias("libcei"), "xmin", "ymin")
    found = nearest.nearest_centre(
        layer(spark, sf, "feat"), S.Point(), spots, gid="id", x="xmin", y="ymin"
    )
    return found.select("gid", "cgid", "libcei", milli(F.col("distance")).alias("distance"))


@query(
    "nearest_centre_lines",
    with_views("feat", "segment") + f""", best as (
        select gid, min({{'d2': {sql.point_segment('x', 'y')}, 'cgid': seg_id}}) as b from feat, segment group by gid)
    select gid, b.cgid as cgid, lib_rte, {milli_sql('sqrt(b.d2)')} as distance from best join segment on seg_id = b.cgid""",
)
def nearest_centre_lines(spark, sf):
    """Points to the nearest line."""
    found = nearest_shapes.nearest_shape(
        layer(spark, sf, "feat"), S.Point(), view(spark, sf, "segment"), S.Segment(), label="lib_rte", gid="seg_id"
    )
    return found.select("gid", "cgid", "lib_rte", milli(F.col("distance")).alias("distance"))


@query(
    "nearest_centre_areas",
    with_views("rect", "segment") + f""", best as (
        select seg_id, min({{'d2': {sql.box_segment()}, 'cgid': id}}) as b from segment, rect group by seg_id)
    select seg_id, b.cgid as cgid, {milli_sql('sqrt(b.d2)')} as distance from best""",
)
def nearest_centre_areas(spark, sf):
    """Lines to the nearest area, both as general geometries; 0 where they meet or one holds the other."""
    lines = view(spark, sf, "segment").select("seg_id", S.Segment().geom().alias("line"))
    areas = view(spark, sf, "rect").select("id", F.lit("area").alias("libcei"), S.Box().geom().alias("geom"))
    found = nearest_shapes.nearest_shape(lines, S.Geom("line"), areas, S.Geom(), gid="id")
    return found.select("seg_id", "cgid", milli(F.col("distance")).alias("distance"))


@query(
    "min_distance",
    with_views("segment", "centre") + f"""
    select lib_rte, c.gid as cgid, libcei, {milli_sql('min(sqrt(' + sql.point_segment('c.x', 'c.y') + '))')} as distance
    from segment, centre c where {sql.point_segment('c.x', 'c.y')} <= {2000.0 * 2000.0} group by 1, 2, 3""",
)
def min_distance(spark, sf):
    """Least distance per (route, centre) over the parts of the route within 2 km."""
    matrix = nearest.distance_matrix(
        view(spark, sf, "segment"), S.Segment(), view(spark, sf, "centre"), 2000.0, key="lib_rte"
    )
    return matrix.withColumn("distance", milli(F.col("distance")))


@query(
    "distinct_on",
    with_views("feat", "centre") + f", {NEAREST_SQL} select gid, cgid, libcei from ranked where rn = 1",
)
def distinct_on(spark, sf):
    """One row per feature, the least by distance and centre, of rows that repeat a feature."""
    found = nearest.nearest_centre(view(spark, sf, "feat"), S.Point(), view(spark, sf, "centre"))
    centre = view(spark, sf, "centre").select(F.col("gid").alias("cgid"), "libcei")
    near = nearest.distance_matrix(view(spark, sf, "feat"), S.Point(), view(spark, sf, "centre"), RADIUS / 5)
    both = found.select("gid", "cgid", "distance").unionByName(near.select("gid", "cgid", "distance"))
    least = nearest.distinct_on(both, "gid", ["distance", "cgid"], ["cgid"])
    return least.join(centre, "cgid").select("gid", "cgid", "libcei")


@query(
    "rank_by_distance",
    with_views("feat", "centre") + f""", {NEAR_SQL}
    select gid, cgid, rank() over (partition by gid order by sqrt(d2) nulls last) as rank from near""",
)
def rank_by_distance(spark, sf):
    """Centres within 25 km in order of distance."""
    matrix = nearest.distance_matrix(view(spark, sf, "feat"), S.Point(), view(spark, sf, "centre"), RADIUS)
    return nearest.rank_by_distance(matrix).select("gid", "cgid", "rank")


# -- intersections -----------------------------------------------------------------------------


def _other(df, prefix="b_"):
    return df.toDF(*[prefix + c for c in df.columns])


OTHER_BOX = S.Box("b_xmin", "b_ymin", "b_xmax", "b_ymax")


@query(
    "intersects_join",
    with_views("rect") + """
    select a.id, b.id as b_id from rect a join rect b on a.id < b.id
       and a.xmin <= b.xmax and b.xmin <= a.xmax and a.ymin <= b.ymax and b.ymin <= a.ymax""",
)
def intersects_join(spark, sf):
    """Pairs of rectangles that share a point."""
    rect = layer(spark, sf, "rect")
    pairs = spatial.intersects_join(rect, S.Box(), _other(rect), OTHER_BOX, CELL)
    return pairs.where("id < b_id").select("id", "b_id")


@query(
    "intersects_join_repeats",
    with_views("rect", "segment") + f"""
    select id % 50 as id, seg_id % 20 as seg_id, count(*) as n
    from (select * from rect union all select * from rect where id % 7 = 0), segment
    where {sql.box_meets_segment()} group by 1, 2""",
)
def intersects_join_repeats(spark, sf):
    """Areas by segments with rows that repeat, in cells of the size that the data suggest."""
    rect = layer(spark, sf, "rect")
    pairs = spatial.intersects_join(
        rect.unionByName(rect.where("id % 7 = 0")), S.Box(), layer(spark, sf, "segment"), S.Segment()
    )
    return pairs.groupBy((F.col("id") % 50).alias("id"), (F.col("seg_id") % 20).alias("seg_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "buffer_intersects_join_default",
    with_views("parcel", "segment") + f"""
    select distinct id, lib_rte from parcel, segment where {sql.box_near_segment(20)} and {sql.box_segment()} <= 400""",
)
def buffer_intersects_join_default(spark, sf):
    """Parcels by 20 m buffers of all routes, in cells of the size that the data suggest."""
    return spatial.buffer_intersects_join(
        layer(spark, sf, "parcel"), S.Box(), "id", layer(spark, sf, "segment"), S.Segment(), "lib_rte", 20.0
    )


@query(
    "intersects_join_parcel",
    with_views("rect", "parcel") + """
    select r.id, p.id as b_id, p.dep as b_dep from rect r join parcel p
        on r.xmin <= p.xmax and p.xmin <= r.xmax and r.ymin <= p.ymax and p.ymin <= r.ymax""",
)
def intersects_join_parcel(spark, sf):
    """Areas by the parcels they meet."""
    parcel = _other(layer(spark, sf, "parcel"))
    pairs = spatial.intersects_join(layer(spark, sf, "rect"), S.Box(), parcel, OTHER_BOX, CELL)
    return pairs.select("id", "b_id", "b_dep")


@query(
    "st_intersects",
    with_views("rect", "segment") + f"""
    select id, seg_id from rect, segment where {sql.box_meets_segment()}""",
)
def st_intersects(spark, sf):
    """Polygons and lines as general geometries: edges on the grid, then containment."""
    rect = layer(spark, sf, "rect").select("id", S.Box().geom().alias("geom"))
    line = layer(spark, sf, "segment").select("seg_id", S.Segment().geom().alias("line"))
    return spatial.geometry_pairs(rect, "id", S.Geom(), line, "seg_id", S.Geom("line"), cell=CELL)


def _near(spark, sf, name, shape, key, radius):
    """Every pair of a layer and a segment within a radius, with the columns of both."""
    left = view(spark, sf, name).select(key, *shape.columns)
    right = layer(spark, sf, "segment").select("seg_id", *S.Segment().columns)
    return spatial.within_distance_join(left, shape, right, S.Segment(), radius, CELL)


@query(
    "st_intersects_row",
    with_views("parcel", "segment") + f"""
    select id, seg_id, {sql.box_meets_segment()} as meets from parcel, segment
    where {sql.box_near_segment(40)} and {sql.box_segment()} <= 1600""",
)
def st_intersects_row(spark, sf):
    """The predicate on geometries that are already in one row: all pairs up to 40 m apart."""
    pairs = _near(spark, sf, "parcel", S.Box(), "id", 40.0)
    return pairs.select("id", "seg_id", G.st_intersects(S.Box().geom(), S.Segment().geom()).alias("meets"))


def _buffer_sql(radius, views, key, d2, near, only_managed=True):
    managed = "gestionnaire = 'OWN' and" if only_managed else ""
    return with_views(*views) + f"""
    select distinct {key}, lib_rte from {views[0]}, segment where {managed} {near} and {d2} <= {radius * radius}"""


@query(
    "buffer_intersects_join",
    _buffer_sql(50, ("parcel", "segment"), "id", sql.box_segment(), sql.box_near_segment(50)),
)
def buffer_intersects_join(spark, sf):
    """Parcels by the 50 m route buffers they meet."""
    managed = layer(spark, sf, "segment").where("gestionnaire = 'OWN'")
    return spatial.buffer_intersects_join(
        layer(spark, sf, "parcel"), S.Box(), "id", managed, S.Segment(), "lib_rte", 50.0, CELL
    )


@query(
    "buffer_intersects_join_point",
    _buffer_sql(500, ("feat", "segment"), "gid", sql.point_segment("x", "y"),
                sql.box_near_segment(500, "x", "y", "x", "y"), only_managed=False),
)
def buffer_intersects_join_point(spark, sf):
    """Points by the 500 m route buffers they lie in."""
    return spatial.buffer_intersects_join(
        layer(spark, sf, "feat"), S.Point(), "gid", layer(spark, sf, "segment"), S.Segment(), "lib_rte", 500.0, CELL
    )


@query(
    "buffer_intersects_join_polygon",
    _buffer_sql(50, ("rect", "segment"), "id", sql.box_segment(), sql.box_near_segment(50)),
)
def buffer_intersects_join_polygon(spark, sf):
    """Polygons as general geometries by the buffers of routes that are general lines."""
    rect = layer(spark, sf, "rect").select("id", S.Box().geom().alias("geom"))
    managed = layer(spark, sf, "segment").where("gestionnaire = 'OWN'")
    routes = managed.select("lib_rte", S.Segment().geom().alias("line"))
    return spatial.buffer_intersects_join(rect, S.Geom(), "id", routes, S.Geom("line"), "lib_rte", 50.0, CELL)


@query(
    "touch_flag",
    with_views("rect", "segment") + f""", hit as (
        select distinct id from rect, segment where gestionnaire = 'OWN' and {sql.box_near_segment(50)}
        and {sql.box_segment()} <= 2500)
    select id, id in (select id from hit) as touches from rect""",
)
def touch_flag(spark, sf):
    rect = layer(spark, sf, "rect")
    managed = layer(spark, sf, "segment").where("gestionnaire = 'OWN'")
    return spatial.touch_flag(rect, S.Box(), managed, S.Segment(), "lib_rte", 50.0, cell=CELL).select("id", "touches")


@query(
    "touch_flag_repeats",
    with_views("rect", "segment") + f""", twice as (
        select id % 40 as id, id % 7 as part, xmin, ymin, xmax, ymax from rect
        union all select null, id % 7, xmin, ymin, xmax, ymax from rect where id % 5 = 0),
    flagged as (
        select *, exists (select 1 from segment where gestionnaire = 'OWN' and {sql.box_near_segment(50)}
                          and {sql.box_segment()} <= 2500) as touches from twice)
    select id, part, xmin, ymin, touches from flagged""",
)
def touch_flag_repeats(spark, sf):
    """Each row its own flag where keys repeat or are missing."""
    rect = layer(spark, sf, "rect")
    named = rect.withColumns({"part": F.col("id") % 7, "key": F.col("id") % 40})
    missing = named.where("id % 5 = 0").withColumn("key", F.lit(None).cast("bigint"))
    rows = named.unionByName(missing).drop("id").withColumnRenamed("key", "id")
    managed = layer(spark, sf, "segment").where("gestionnaire = 'OWN'")
    flagged = spatial.touch_flag(rows, S.Box(), managed, S.Segment(), "lib_rte", 50.0, cell=CELL)
    return flagged.select("id", "part", "xmin", "ymin", "touches")


def _radius_sql(text):
    return f"(case when {text} % 9 = 4 then null when {text} % 3 = 0 then 400.0 else 20.0 + {text} % 25 * 5 end)"


@query(
    "buffer_intersects_join_radii",
    with_views("parcel", "segment") + f""", part as (select *, {_radius_sql('seg_id')} as r from segment)
    select distinct id, lib_rte, cast(r as double) as radius from parcel, part
    where {sql.box_near_segment(400)} and {sql.box_segment()} <= r * r""",
)
def buffer_intersects_join_radii(spark, sf):
    """Parcels by route buffers whose parts have a radius each, or none."""
    parts = layer(spark, sf, "segment").withColumn("radius", F.expr(_radius_sql("seg_id")).cast("double"))
    return spatial.buffer_intersects_join(layer(spark, sf, "parcel"), S.Box(), "id", parts, S.Segment(), "lib_rte", "radius")


@query(
    "distinct_expr",
    with_views("rect", "segment") + f""", hit as (
        select distinct id, lib_rte from rect, segment where {sql.box_near_segment(50)} and {sql.box_segment()} <= 2500),
    route as (select distinct lib_rte from segment)
    select distinct (hit.id is not null) as touches
    from (select id, lib_rte from rect, route) a left join hit on hit.id = a.id and hit.lib_rte = a.lib_rte""",
)
def distinct_expr(spark, sf):
    """Which outcomes the buffer test has over all (area, route) combinations."""
    rect, segment = layer(spark, sf, "rect"), layer(spark, sf, "segment")
    pairs = spatial.buffer_intersects_join(rect, S.Box(), "id", segment, S.Segment(), "lib_rte", 50.0, CELL)
    return spatial.distinct_outcomes(
        rect.agg(F.count(F.lit(1))), segment.agg(F.count_distinct("lib_rte")), pairs
    )


@query(
    "grid_layout_join",
    with_views("parcel", "segment") + f"""
    select id, dep, seg_id from parcel, segment where {sql.box_near_segment(50)} and {sql.box_segment()} <= 2500""",
)
def grid_layout_join(spark, sf):
    """Parcels stored in balanced tiles, joined to segments up to 50 m away without a shuffle of the parcels."""
    path = scratch_path(spark, "tiles")
    spark.sql("create schema if not exists layers")
    table = "layers.parcel_" + path[-32:]
    tiles.write_tiles(layer(spark, sf, "parcel"), S.Box(), table, path, tile_rows=20_000)
    right = layer(spark, sf, "segment").select("seg_id", *S.Segment().columns)
    return tiles.tile_join(spark, table, path, S.Box(), right, S.Segment(), 50.0).select("id", "dep", "seg_id")


# -- routes ------------------------------------------------------------------------------------

PARTS_SQL = """parts as (
    select distinct lib_rte,
        case when x2 < x1 or (x2 = x1 and y2 < y1) then x2 else x1 end as x1,
        case when x2 < x1 or (x2 = x1 and y2 < y1) then y2 else y1 end as y1,
        case when x2 < x1 or (x2 = x1 and y2 < y1) then x1 else x2 end as x2,
        case when x2 < x1 or (x2 = x1 and y2 < y1) then y1 else y2 end as y2
    from segment)"""


@query(
    "dissolve_routes",
    with_views("segment") + f""", {PARTS_SQL}
    select lib_rte, count(*) as n_parts, floor(sum(sqrt((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))) * 10 + 0.5) / 10 as length,
           min(least(x1, x2)) as xmin, min(least(y1, y2)) as ymin,
           max(greatest(x1, x2)) as xmax, max(greatest(y1, y2)) as ymax
    from parts group by lib_rte""",
)
def dissolve_routes(spark, sf):
    parts = dissolve.dissolve_parts(view(spark, sf, "segment"), "lib_rte")
    summary = dissolve.route_summary(parts, "lib_rte")
    return summary.withColumn("length", F.floor(F.col("length") * 10 + 0.5) / 10)


@query("st_union", with_views("segment") + f", {PARTS_SQL} select lib_rte, x1, y1, x2, y2 from parts")
def st_union(spark, sf):
    """The dissolved routes in long form, from general line geometries."""
    lines = view(spark, sf, "segment").select("lib_rte", S.Segment().geom().alias("geom"))
    return dissolve.dissolve_parts(dissolve.explode_edges(lines, "lib_rte"), "lib_rte")


@query(
    "st_buffer",
    with_views("segment") + """
    select seg_id, cast(floor(2 * 50 * sqrt((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2)) + 16 * 2500 * sin(pi() / 16) + 0.5) as bigint) as area
    from segment""",
)
def st_buffer(spark, sf):
    """Area of the capsule polygon of each segment, in whole square metres."""
    ends = S.Segment().ends()
    return view(spark, sf, "segment").select(
        "seg_id", F.floor(G.st_area(G.capsule(*ends, 50.0)) + 0.5).cast("bigint").alias("area")
    )


# -- functions ---------------------------------------------------------------------------------


@query(
    "st_distance",
    with_views("feat", "segment") + f"""
    select gid, seg_id, {milli_sql('sqrt(' + sql.point_segment('x', 'y') + ')')} as distance
    from feat, segment where {sql.point_segment('x', 'y')} <= 160000""",
)
def st_distance(spark, sf):
    """Point to segment, closed form: all pairs up to 400 m apart."""
    pairs = _near(spark, sf, "feat", S.Point(), "gid", 400.0)
    return pairs.select("gid", "seg_id", milli(F.sqrt(S.distance2(S.Point(), S.Segment()))).alias("distance"))


@query(
    "st_distance_box",
    with_views("parcel", "segment") + f"""
    select id, seg_id, {milli_sql('sqrt(' + sql.box_segment() + ')')} as distance from parcel, segment
    where {sql.box_near_segment(40)} and {sql.box_segment()} <= 1600""",
)
def st_distance_box(spark, sf):
    """Area to line with general geometries: all pairs up to 40 m apart."""
    pairs = _near(spark, sf, "parcel", S.Box(), "id", 40.0)
    return pairs.select("id", "seg_id", milli(G.st_distance(S.Box().geom(), S.Segment().geom())).alias("distance"))


@query(
    "geom_kind",
    with_views("segment") + """
    select seg_id, 'LINESTRING' as kind, 2 as dim, 2154 as srid, true as has_geometry from segment""",
)
def geom_kind(spark, sf):
    layer = view(spark, sf, "segment").select("seg_id", S.Segment().geom().alias("geom"))
    return layer.select(
        "seg_id", F.col("geom.kind").alias("kind"), F.col("geom.dim").alias("dim"),
        F.col("geom.srid").alias("srid"), F.col("geom").isNotNull().alias("has_geometry"),
    )
