"""Composite jobs over the derived layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravia.functions import shapes as S
from terravia.plans import jobs
from terravia.plans import oracle_sql as sql
from terravia.plans.fixtures import layer, view, with_views
from terravia.plans.queries_layers import LAMBERT_X, LAMBERT_Y
from terravia.plans.queries_space import CELL, NEAREST_SQL, PARTS_SQL
from terravia.plans.registry import milli, milli_sql, query
from terravia.session import scratch_path
from terravia.sources import sinks

YEAR = 2016
DEPS = (14, 15, 16, 17)
FEAT = S.Point()


@query(
    "job_import",
    with_views("lonlat") + f" select gid, {milli_sql(LAMBERT_X)} as x, {milli_sql(LAMBERT_Y)} as y from lonlat",
)
def job_import(spark, sf):
    """Names, projection, write, layout, statistics, key check, view and profile of one layer."""
    raw = view(spark, sf, "lonlat").toDF("GID", "Lon", "LAT")
    imported = jobs.import_layer(
        raw, "localisant_14", scratch_path(spark, "import"), primary_key="gid", shape=FEAT,
        source_srid=4326, lonlat=("lon", "lat"),
    )
    return spark.table(imported.view).select("gid", milli(F.col("x")).alias("x"), milli(F.col("y")).alias("y"))


@query(
    "job_cei_by_geometry",
    with_views("feat", "centre", "lookup") + f""", {NEAREST_SQL}
    select f.gid, f.x, f.y, r.libcei as _cei, district as _district
    from feat f left join (select * from ranked where rn = 1) r on r.gid = f.gid left join lookup on cei = r.libcei""",
)
def job_cei_by_geometry(spark, sf):
    done = jobs.import_tagged(
        view(spark, sf, "feat"), "feat_cei", scratch_path(spark, "cei"), view(spark, sf, "lookup"),
        view(spark, sf, "centre"), FEAT, primary_key="gid",
    )
    return spark.table(done.view)


@query(
    "job_cei_by_nearest_area",
    with_views("feat", "rect", "lookup") + f""", zone as (
        select id as zid, libcei, xmin, ymin, xmax, ymax from rect join (select gid, libcei from centre_names) n on gid = id % 25),
    best as (select gid, min({{'d2': {sql.point_box('x', 'y')}, 'zid': zid, 'libcei': libcei}}) as b from feat, zone group by gid)
    select f.gid, x, y, b.libcei as _cei, district as _district
    from feat f join best on best.gid = f.gid left join lookup on cei = b.libcei""".replace(
        "select gid, libcei from centre_names", "select n_nationkey as gid, n_name as libcei from nation"
    ),
)
def job_cei_by_nearest_area(spark, sf):
    """Features with the centre whose zone is nearest, and its district; zones are areas."""
    names = view(spark, sf, "centre").select(F.col("gid").alias("n"), "libcei")
    zones = view(spark, sf, "rect").withColumn("n", F.col("id") % 25).join(names, "n").withColumnRenamed("id", "gid")
    done = jobs.import_tagged(
        view(spark, sf, "feat"), "feat_zone", scratch_path(spark, "cei"), view(spark, sf, "lookup"), zones, FEAT,
        centre_shape=S.Box(),
    )
    return spark.table(done.view).select("gid", "x", "y", "_cei", "_district")


@query(
    "job_cei_by_attribute",
    with_views("feat_valid", "lookup") + """
    select gid, cei_field, cei_field as _cei, district as _district
    from feat_valid left join lookup on cei = cei_field""",
)
def job_cei_by_attribute(spark, sf):
    """Lower-case codes pass the check and get no district, as the lookup compares them as they are."""
    layer = view(spark, sf, "feat_valid").drop("district_field")
    done = jobs.import_tagged(
        layer, "feat_field", scratch_path(spark, "cei"), view(spark, sf, "lookup"), field="cei_field"
    )
    return spark.table(done.table)


@query(
    "job_district_by_geometry",
    with_views("feat", "centre", "lookup") + f""", {NEAREST_SQL}
    select f.gid, f.x, f.y, district as _district
    from feat f left join (select * from ranked where rn = 1) r on r.gid = f.gid left join lookup on cei = r.libcei""",
)
def job_district_by_geometry(spark, sf):
    done = jobs.import_districts(
        view(spark, sf, "feat"), "feat_district", scratch_path(spark, "district"), view(spark, sf, "lookup"),
        view(spark, sf, "centre"), FEAT,
    )
    return spark.table(done.view)


@query(
    "job_district_by_attribute",
    with_views("feat_valid") + " select gid, district_field, district_field as _district from feat_valid",
)
def job_district_by_attribute(spark, sf):
    layer = view(spark, sf, "feat_valid").drop("cei_field")
    done = jobs.import_districts(
        layer, "feat_district_field", scratch_path(spark, "district"), view(spark, sf, "lookup"), field="district_field"
    )
    return spark.table(done.table)


def _buffers(spark, sf):
    """Load the network as a vintage, store its buffers and read them back."""
    raw = view(spark, sf, "segment")
    loaded = jobs.load_network(raw.toDF(*[c.upper() for c in raw.columns]), scratch_path(spark, "network"), YEAR)
    path = scratch_path(spark, "buffers")
    jobs.store_buffers(loaded, path)
    return jobs.read_buffers(spark, path)


@query(
    "job_network_buffer",
    with_views("segment").replace("from part)", "from part where p_type not in ('PROMO', 'LARGE'))")
    + f", {PARTS_SQL} select lib_rte, x1, y1, x2, y2, 50.0::double as radius from parts",
)
def job_network_buffer(spark, sf):
    """Load one manager's network as a vintage, then dissolve, buffer and store it."""
    return _buffers(spark, sf)


@query(
    "job_commune_intersect",
    with_views("rect", "segment") + f"""
    select distinct id, xmin, ymin, xmax, ymax, lib_rte, 50.0::double as radius, 'commune' as layer, {YEAR} as millesime
    from rect, segment where gestionnaire = 'OWN' and {sql.box_near_segment(50)} and {sql.box_segment()} <= 2500""",
)
def job_commune_intersect(spark, sf):
    name = "geo/COMMUNE_2016"
    done = jobs.import_layer(layer(spark, sf, "rect"), "commune_2016", scratch_path(spark, "layer"), shape=S.Box(),
                             primary_key="id")
    return jobs.commune_intersect(
        done.layer.drop("gid"), S.Box(), _buffers(spark, sf), scratch_path(spark, "commune"), name, YEAR, cell=CELL
    )


@query(
    "job_parcel_intersect",
    with_views("parcel", "segment") + f"""
    select distinct id, xmin, ymin, xmax, ymax, lib_rte, 50.0::double as radius, 'parcelle' as layer, dep
    from parcel, segment where gestionnaire = 'OWN'
      and {sql.box_near_segment(50)} and {sql.box_segment()} <= 2500""",
)
def job_parcel_intersect(spark, sf):
    """Parcels of every département by route buffer: one join, stored by département."""
    parcels = jobs.import_layer(layer(spark, sf, "parcel"), "parcelle", scratch_path(spark, "layer"), shape=S.Box(), primary_key="id")
    return jobs.parcel_intersect(
        parcels.layer.drop("gid"), S.Box(), _buffers(spark, sf), scratch_path(spark, "parcel"), "geo/PARCELLE", cell=CELL
    )


@query(
    "job_commune_intersect_repeats",
    with_views("rect", "segment") + f""", twice as (
        select id % 40 as id, xmin, ymin, xmax, ymax from rect union all select null, xmin, ymin, xmax, ymax from rect where id % 5 = 0)
    select distinct id, xmin, ymin, xmax, ymax, lib_rte, 50.0::double as radius, 'commune' as layer, {YEAR} as millesime
    from twice, segment where gestionnaire = 'OWN' and {sql.box_near_segment(50)} and {sql.box_segment()} <= 2500""",
)
def job_commune_intersect_repeats(spark, sf):
    """Communes whose key repeats or is missing: each row has its own buffers."""
    rect = view(spark, sf, "rect")
    missing = rect.where("id % 5 = 0").withColumn("id", F.lit(None).cast("bigint"))
    rows = rect.withColumn("id", F.col("id") % 40).unionByName(missing)
    return jobs.commune_intersect(
        rows, S.Box(), _buffers(spark, sf), scratch_path(spark, "commune"), "geo/COMMUNE_2016", YEAR, cell=CELL
    )


@query(
    "job_localisant_intersect",
    with_views("feat", "segment") + f"""
    select distinct gid, x, y, lib_rte, 50.0::double as radius, 'localisant' as layer, {DEPS[0]} as dep
    from feat, segment where gestionnaire = 'OWN'
      and {sql.box_near_segment(50, 'x', 'y', 'x', 'y')} and {sql.point_segment('x', 'y')} <= 2500""",
)
def job_localisant_intersect(spark, sf):
    """Address points by route buffer."""
    done = jobs.import_layer(layer(spark, sf, "feat"), "localisant_14", scratch_path(spark, "layer"), shape=FEAT)
    return jobs.parcel_intersect(
        done.layer, FEAT, _buffers(spark, sf), scratch_path(spark, "parcel"), "geo/localisant_14", DEPS[0], cell=CELL
    )


@query(
    "job_departement_flag",
    with_views("rect", "segment") + f""", hit as (
        select distinct id from rect, segment where gestionnaire = 'OWN' and {sql.box_near_segment(50)}
        and {sql.box_segment()} <= 2500)
    select id, xmin, ymin, xmax, ymax, id in (select id from hit) as on_network from rect""",
)
def job_departement_flag(spark, sf):
    done = jobs.departement_flag(
        layer(spark, sf, "rect"), S.Box(), _buffers(spark, sf), "DEPARTEMENT", scratch_path(spark, "layer"), cell=CELL
    )
    return spark.table(done.view).drop("gid")
