"""Union and buffers of whole routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravia.operators import buffer, dissolve, union
from terravia.plans.fixtures import layer, with_views
from terravia.plans.registry import query

#: Merged parts of the layer ``overlap`` with whole coordinates: intervals on lines, then gaps between them.
UNION_SQL = """vec as (
    select distinct lib_rte, cast(least(x1, x2) as bigint) as ax, cast(greatest(x1, x2) as bigint) as bx,
           cast(case when x1 < x2 or (x1 = x2 and y1 < y2) then y1 else y2 end as bigint) as ay,
           cast(case when x1 < x2 or (x1 = x2 and y1 < y2) then y2 else y1 end as bigint) as b_y
    from overlap where x1 <> x2 or y1 <> y2),
dir as (select *, gcd(bx - ax, b_y - ay) as g from vec),
line as (select *, (bx - ax) // g as ux, (b_y - ay) // g as uy from dir),
keyed as (
    select lib_rte, ux, uy, ux * ay - uy * ax as c, case when ux = 0 then ay else ax end as p, case when ux = 0 then b_y else bx end as q,
           ax, ay, bx, b_y from line),
reach as (select *, max(q) over (partition by lib_rte, ux, uy, c order by p, q rows between unbounded preceding and 1 preceding) as m from keyed),
runs as (select *, sum(case when m is null or p > m then 1 else 0 end) over (
    partition by lib_rte, ux, uy, c order by p, q rows between unbounded preceding and current row) as run from reach),
parts as (
    select lib_rte, cast(min({'p': p, 'x': ax, 'y': ay}).x as double) as x1, cast(min({'p': p, 'x': ax, 'y': ay}).y as double) as y1,
           cast(max({'q': q, 'x': bx, 'y': b_y}).x as double) as x2, cast(max({'q': q, 'x': bx, 'y': b_y}).y as double) as y2
    from runs group by lib_rte, ux, uy, c, run)"""
SPOTS_SQL = "select distinct lib_rte, x1, y1, x2, y2 from overlap where x1 = x2 and y1 = y2"


@query("st_union_overlaps", with_views("overlap") + f", {UNION_SQL} select * from parts union all {SPOTS_SQL}")
def st_union_overlaps(spark, sf):
    """The union of each route's lines where parts cover each other in part."""
    return union.union_parts(layer(spark, sf, "overlap"), "lib_rte")


@query(
    "dissolve_routes_overlaps",
    with_views("overlap") + f""", {UNION_SQL}, everything as (select * from parts union all {SPOTS_SQL})
    select lib_rte, count(*) as n_parts, floor(sum(sqrt((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))) * 10 + 0.5) / 10 as length,
           min(least(x1, x2)) as xmin, min(least(y1, y2)) as ymin,
           max(greatest(x1, x2)) as xmax, max(greatest(y1, y2)) as ymax
    from everything group by lib_rte""",
)
def dissolve_routes_overlaps(spark, sf):
    """Parts, length and extent of each route; what several parts cover counts once."""
    summary = dissolve.route_summary(union.union_parts(layer(spark, sf, "overlap"), "lib_rte"), "lib_rte")
    return summary.withColumn("length", F.floor(F.col("length") * 10 + 0.5) / 10)


@query(
    "st_union_noded",
    with_views("overlap") + f""", {UNION_SQL}, numbered as (select *, row_number() over () as n from parts),
    pairs as (
      select a.n as an, b.n as bn, a.lib_rte, a.x1 as ax, a.y1 as ay, a.x2 - a.x1 as adx, a.y2 - a.y1 as ady,
             b.x1 as bx, b.y1 as b_y, b.x2 - b.x1 as bdx, b.y2 - b.y1 as bdy,
             (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) as turn
      from numbered a join numbered b on a.lib_rte = b.lib_rte and a.n < b.n),
    met as (
      select *, ((bx - ax) * bdy - (b_y - ay) * bdx) / turn as s, ((bx - ax) * ady - (b_y - ay) * adx) / turn as t from pairs where turn <> 0),
    places as (
      select an, bn, floor((ax + s * adx) * 1000 + 0.5) / 1000 as x, floor((ay + s * ady) * 1000 + 0.5) / 1000 as y
      from met where s between 0 and 1 and t between 0 and 1),
    cuts as (
      select distinct n, x, y from (select an as n, x, y from places union all select bn, x, y from places)
      join numbered using (n) where not (x = x1 and y = y1) and not (x = x2 and y = y2))
    select lib_rte, count(distinct n) as n_parts, count(distinct n) + count(x) as n_pieces
    from numbered left join (select n as cn, x from cuts) on cn = n group by lib_rte""",
)
def st_union_noded(spark, sf):
    """Parts of each route's union and the pieces into which crossings cut them."""
    parts = union.union_parts(layer(spark, sf, "overlap"), "lib_rte").where("x1 <> x2 or y1 <> y2")
    pieces = union.node_parts(parts, "lib_rte")
    return pieces.groupBy("lib_rte").agg(F.count_distinct("part").alias("n_parts"), F.count(F.lit(1)).alias("n_pieces"))


#: Outline of the capsules of each route's parts, every edge cut by every capsule of the route whose box is near.
OUTLINE_SQL = """everything as (
      select row_number() over () as n, lib_rte, x1, y1, x2, y2, x1 = x2 and y1 = y2 as lone,
             cast(round(atan2(x1 - x2, y2 - y1) * 16 / pi()) + 32 as bigint) % 32 as rc
      from (select * from parts union all {spots})),
    pen as (select k, {r} * cos(k * pi() / 16) as px, {r} * sin(k * pi() / 16) as py,
                   {r} * cos((k + 1) % 32 * pi() / 16) as qx, {r} * sin((k + 1) % 32 * pi() / 16) as qy
            from (select unnest(range(32)) as k)),
    hull as (
      select n, lib_rte, (case when not lone and (k - rc + 32) % 32 < 16 then x2 else x1 end) + px as bx,
             (case when not lone and (k - rc + 32) % 32 < 16 then y2 else y1 end) + py as b_y,
             (case when not lone and (k - rc + 32) % 32 < 16 then x2 else x1 end) + qx as ex,
             (case when not lone and (k - rc + 32) % 32 < 16 then y2 else y1 end) + qy as ey
      from everything, pen
      union all select n, lib_rte, x1 + px, y1 + py, x2 + px, y2 + py from everything join pen on k = rc where not lone
      union all select n, lib_rte, x2 + px, y2 + py, x1 + px, y1 + py from everything join pen on k = (rc + 16) % 32 where not lone),
    edge as (select *, sqrt((ex - bx) * (ex - bx) + (ey - b_y) * (ey - b_y)) as len, row_number() over () as e
             from (select distinct lib_rte, bx, b_y, ex, ey from hull)),
    near as (
      select e, n, edge.lib_rte, bx, b_y, ex - bx as sx, ey - b_y as sy, len
      from edge join everything p on edge.lib_rte = p.lib_rte
       and least(bx, ex) <= greatest(x1, x2) + {r} and greatest(bx, ex) >= least(x1, x2) - {r}
       and least(b_y, ey) <= greatest(y1, y2) + {r} and greatest(b_y, ey) >= least(y1, y2) - {r}),
    met as (
      select e, near.n, len, ((h.ex - h.bx) * (near.b_y - h.b_y) - (h.ey - h.b_y) * (near.bx - h.bx)) / hl as depth,
             ((h.ex - h.bx) * sy - (h.ey - h.b_y) * sx) / hl as slope
      from near join (select *, sqrt((ex - bx) * (ex - bx) + (ey - b_y) * (ey - b_y)) as hl from hull) h on h.n = near.n),
    cut as (
      select e, n, max(len) as len, max(case when slope >= 1e-9 then -depth / slope else -1e9 end) as s0,
             min(case when slope <= -1e-9 then -depth / slope else 1e9 end) as s1
      from met group by e, n having not bool_or(abs(slope) < 1e-9 and depth <= 5e-7)),
    inner_part as (
      select e, case when s0 <= 1e-6 / len then -1 else s0 end as s0, case when s1 >= 1 - 1e-6 / len then 2 else s1 end as s1
      from cut where least(s1, 1) - greatest(s0, 0) > 1e-6 / len),
    bounds as (select e, -2.0::double as s0, 0.0::double as s1 from edge union all select e, 1.0, 3.0 from edge union all select * from inner_part),
    swept as (select *, max(s1) over (partition by e order by s0, s1 rows between unbounded preceding and 1 preceding) as reach from bounds),
    piece as (select edge.*, reach, s0 from swept join edge using (e) where s0 > reach and (s0 - reach) * len > 1e-6),
    ends as (select lib_rte, bx + reach * (ex - bx) - 400000 as px, b_y + reach * (ey - b_y) - 6850000 as py,
                    bx + s0 * (ex - bx) - 400000 as qx, b_y + s0 * (ey - b_y) - 6850000 as qy from piece)"""


@query(
    "st_buffer_dissolved",
    with_views("overlap") + f", {UNION_SQL}, {OUTLINE_SQL.format(r=50.0, spots=SPOTS_SQL)}" + """
    select lib_rte, floor(sum(px * qy - qx * py) / 2 + 0.5) as area,
           floor(sum(sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))) + 0.5) as perimeter, count(*) as n_edges
    from ends group by lib_rte""",
)
def st_buffer_dissolved(spark, sf):
    """Area and outline of the dissolved 50 m buffer of each route, in whole metres."""
    rings = buffer.dissolved_buffer(layer(spark, sf, "overlap"), "lib_rte", 50.0)
    found = buffer.buffer_summary(rings, "lib_rte")
    whole = [F.floor(F.col(c) + 0.5).cast("double").alias(c) for c in ("area", "perimeter")]
    return found.select("lib_rte", *whole, "n_edges")
