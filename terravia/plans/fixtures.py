"""Layers derived from the given tables by SQL that runs unchanged in Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravia.session import use_all_cores

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

def _shifted(half_steps: int, turned: bool) -> str:
    """Segments moved along themselves by so many halves of their length, ends swapped where ``turned``."""
    dx, dy = "((p_partkey % 7) * 300 - 900)", "((p_partkey % 5) * 400 - 800)"
    x, y = "(400000 + (p_partkey * 7507) % 100000", "(6850000 + (p_partkey * 9109) % 100000"
    near = [f"cast({p} + {half_steps} * {d} / 2) as double) as {{}}" for p, d in ((x, dx), (y, dy))]
    far = [f"cast({p} + {half_steps + 2} * {d} / 2) as double) as {{}}" for p, d in ((x, dx), (y, dy))]
    ends = [*far, *near] if turned else [*near, *far]
    named = ", ".join(e.format(n) for e, n in zip(ends, ("x1", "y1", "x2", "y2")))
    return f"select p_partkey as seg_id, p_brand as lib_rte, {named} from {{part}}"


VIEWS = {
    "centre": """
        select n_nationkey as gid, n_name as libcei,
               cast(400000 + (n_nationkey * 48611) % 100000 as double) as x,
               cast(6850000 + (n_nationkey * 31337) % 100000 as double) as y
        from {nation}""",
    "lookup": """
        select n_name as cei, r_name as district
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "feat": """
        select c_custkey as gid,
               cast(400000 + (c_custkey * 7919) % 100000 as double) as x,
               cast(6850000 + (c_custkey * 6271) % 100000 as double) as y
        from {customer}""",
    "feat_attr": """
        select c_custkey as gid,
               case when c_custkey % 50 = 0 then 'UNKNOWN_CEI'
                    when c_custkey % 10 = 0 then lower(n_name)
                    else n_name end as cei_field
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "feat_valid": """
        select c_custkey as gid,
               case when c_custkey % 10 = 0 then lower(n_name) else n_name end as cei_field,
               r_name as district_field
        from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "segment": """
        select p_partkey as seg_id, p_brand as lib_rte,
               case when p_type in ('PROMO', 'LARGE') then 'OTHER' else 'OWN' end as gestionnaire,
               cast(400000 + (p_partkey * 7507) % 100000 as double) as x1,
               cast(6850000 + (p_partkey * 9109) % 100000 as double) as y1,
               cast(400000 + (p_partkey * 7507) % 100000 + (p_partkey % 7) * 300 - 900 as double) as x2,
               cast(6850000 + (p_partkey * 9109) % 100000 + (p_partkey % 5) * 400 - 800 as double) as y2
        from {part}""",
    # every segment, a copy that covers half of it, and one that only touches its end
    "overlap": f"""
        {_shifted(0, False)} union all {_shifted(1, False)} union all {_shifted(2, True)}""",
    "rect": """
        select s_suppkey as id,
               cast(400000 + (s_suppkey * 4001) % 50000 as double) as xmin,
               cast(6850000 + (s_suppkey * 5003) % 50000 as double) as ymin,
               cast(400000 + (s_suppkey * 4001) % 50000 + 500 + (s_suppkey % 11) * 700 as double) as xmax,
               cast(6850000 + (s_suppkey * 5003) % 50000 + 500 + (s_suppkey % 13) * 600 as double) as ymax
        from {supplier}""",
    "parcel": """
        select o_orderkey as id, 14 + o_orderkey % 4 as dep,
               cast(400000 + (o_orderkey * 3001) % 100000 as double) as xmin,
               cast(6850000 + (o_orderkey * 7001) % 100000 as double) as ymin,
               cast(400000 + (o_orderkey * 3001) % 100000 + 100 + (o_orderkey % 9) * 50 as double) as xmax,
               cast(6850000 + (o_orderkey * 7001) % 100000 + 100 + (o_orderkey % 8) * 50 as double) as ymax
        from {orders}""",
    "lonlat": """
        select c_custkey as gid,
               -1.5e0 + (c_custkey % 400) * 1e-2 as lon,
               48e0 + (c_custkey % 250) * 1e-2 as lat
        from {customer}""",
    "grants": """
        select distinct event_id - event_id % 4 as object_id, event_type as privilege from {events}""",
    "object": """
        select distinct event_id - event_id % 4 as object_id,
               case (event_id - event_id % 4) % 3 when 0 then 'pg_own' when 1 then 'roads' else 'stock' end as schema,
               case when event_id % 8 < 4 then 'r' else 'v' end as type,
               case when (event_id - event_id % 4) % 5 = 0 then 'geom' end as geom_column
        from {events}""",
    "layer_name": """
        select page_id,
               concat(url, case page_id % 6 when 0 then '/COMMUNE_2014.shp' when 1 then '/n_departement'
                                when 2 then '/Parcelle_localisant' when 3 then '/LOCALISANT.tab'
                                when 4 then '/commune/route' else '' end) as name
        from {pages}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived layer as a DataFrame."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived layer spread over the cores, for joins that do much work per row."""
    return use_all_cores(view(spark, sf_dir, name))


def with_views(*names: str) -> str:
    """``with`` clause that defines derived layers over the raw tables."""
    plain = {t: t for t in TABLES}
    return "with " + ", ".join(f"{n} as ({VIEWS[n].format(**plain)})" for n in names)
