"""Spatial joins and flags built on the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import geom as G
from terravia.functions import shapes as S
from terravia.operators.first_hits import HIT_OPTIONS, met_groups
from terravia.operators.grid import Radius, choose_cell, grid_candidates, needs_distinct, reach_of
from terravia.operators.joins import salted_join
from terravia.operators.profile import require_same_srid
from terravia.session import cut_lineage, use_all_cores


def _named(radius: Radius) -> list[str]:
    """The column of a radius per row."""
    return [radius] if isinstance(radius, str) else []


def grid_join(
    left: DataFrame,
    left_shape: S.Shape,
    right: DataFrame,
    right_shape: S.Shape,
    test: Column,
    cell: float | None = None,
    radius: Radius = 0.0,
    **options,
) -> DataFrame:
    """Every pair of rows within ``radius`` by bounding box that passes the exact ``test``, once each.

    Equal rows are rows of their own: each gives its own pairs. With segments on both sides a pair
    can come from several cells; the rows are then numbered (and written, so the numbers stay), only
    numbers and coordinates go through the grid, and the other columns are joined to the pairs.
    Geometry columns with different SRIDs fail.
    """
    if isinstance(left_shape, S.Geom) and isinstance(right_shape, S.Geom):
        left = require_same_srid(left, right, left_shape.column, right_shape.column)
    cell = cell or choose_cell(right, right_shape, radius)
    if not needs_distinct(left_shape, right_shape):
        return grid_candidates(left, left_shape, right, right_shape, cell, radius, **options).where(test)
    a = cut_lineage(left.withColumn("_ln", F.monotonically_increasing_id()), "left")
    b = cut_lineage(right.withColumn("_rn", F.monotonically_increasing_id()), "right")
    near = grid_candidates(
        a.select("_ln", *left_shape.columns), left_shape, b.select("_rn", *right_shape.columns, *_named(radius)), right_shape, cell,
        radius, **options,
    )
    pairs = near.where(test).select("_ln", "_rn").distinct()
    return pairs.join(a, "_ln").join(b, "_rn").select(*left.columns, *right.columns)


def intersects_join(
    left: DataFrame, left_shape: S.Shape, right: DataFrame, right_shape: S.Shape, cell: float | None = None, **options
) -> DataFrame:
    """One row per pair of geometries that share a point, with the columns of both."""
    return grid_join(
        left, left_shape, right, right_shape, S.intersects(left_shape, right_shape), cell, **options
    )


def within_distance_join(
    left: DataFrame,
    left_shape: S.Shape,
    right: DataFrame,
    right_shape: S.Shape,
    radius: Radius,
    cell: float | None = None,
    **options,
) -> DataFrame:
    """One row per pair at most ``radius`` apart; a column of ``right`` may be the radius."""
    near = S.within(left_shape, right_shape, reach_of(radius))
    return grid_join(left, left_shape, right, right_shape, near, cell, radius, **options)


def _edges_of(df: DataFrame, key: str, shape: S.Shape, tag: str, more: list[str]) -> tuple[DataFrame, S.Segment]:
    """One row per straight edge of every geometry: key, four tagged columns and ``more``."""
    named = S.Segment(*[tag + c for c in ("x1", "y1", "x2", "y2")])
    present = df.where(shape.present())
    if isinstance(shape, S.Segment):
        return present.select(key, *more, *[F.col(c).alias(n) for c, n in zip(shape.columns, named.columns)]), named
    listed = present.select(key, *more, F.explode(G.edges(shape.geom())).alias("_e"))
    return listed.select(key, *more, *[F.col("_e")[c].alias(n) for c, n in zip(("x1", "y1", "x2", "y2"), named.columns)]), named


def _starts_of(df: DataFrame, key: str, shape: S.Shape, tag: str, more: list[str]) -> tuple[DataFrame, S.Point]:
    """The first vertex of every part."""
    named = S.Point(tag + "px", tag + "py")
    present = df.where(shape.present())
    if isinstance(shape, S.Segment):
        return present.select(key, *more, F.col(shape.x1).alias(named.x), F.col(shape.y1).alias(named.y)), named
    first = F.transform(shape.geom()["parts"], lambda p: F.get(p["pts"], F.lit(0)))
    listed = present.select(key, *more, F.explode(first).alias("_p"))
    return listed.select(key, *more, F.col("_p.x").alias(named.x), F.col("_p.y").alias(named.y)), named


HOLDING = S.Box("_bx0", "_by0", "_bx1", "_by1")


def _holding(areas: DataFrame, area_key: str, area: S.Shape, others: DataFrame, key: str, shape: S.Shape, cell, options, more, met=False):
    """Pairs in which an area holds the first vertex of a part of the other geometry.

    Keys and boxes find the candidates; the polygon itself joins only them. Rows of the candidates
    with a NULL key have no pair. With ``met``, areas have a list ``_met`` of pairs that are known and left out.
    """
    known = ["_met"] if met else []
    unknown = ~F.coalesce(F.array_contains("_met", F.struct(key, *more)), F.lit(False)) if met else F.lit(True)
    if isinstance(area, S.Box):
        # a box holds what lies in it; what lies on its edge meets it as well
        boxes = areas.where(area.present()).select(
            area_key, *known, *[F.col(c).alias(n) for c, n in zip(area.columns, HOLDING.columns)]
        )
        starts, point = _starts_of(others, key, shape, "_s", more)
        return grid_candidates(starts, point, boxes, HOLDING, cell, **options).where(unknown).select(area_key, key, *more)
    polygons = areas.where(area.present()).select(area_key, area.geom().alias("_polygon"), *known)
    polygons = polygons.where(G.is_area(F.col("_polygon")))
    box = HOLDING
    boxes = polygons.select(area_key, *known, *[b.alias(n) for b, n in zip(G.bounds(F.col("_polygon")), box.columns)])
    starts, point = _starts_of(others, key, shape, "_s", more)
    found = grid_candidates(starts, point, boxes, box, cell, **options).where(unknown).select(area_key, key, *more, point.x, point.y)
    # one area may hold most of the points: its key is dealt to as many salts as they need
    held = salted_join(found, polygons.drop(*known), area_key).where(
        G.inside(F.col(point.x), F.col(point.y), G.edges(F.col("_polygon")))
    )
    return held.select(area_key, key, *more)


def geometry_pairs(
    left: DataFrame,
    left_key: str,
    left_shape: S.Shape,
    right: DataFrame,
    right_key: str,
    right_shape: S.Shape,
    radius: Radius = 0.0,
    cell: float | None = None,
    once: bool = False,
    **options,
) -> DataFrame:
    """Distinct ``(left_key, right_key)`` of geometries at most ``radius`` apart, of any kind.

    ``once``: many rows have the same ``right_key``, so one hit of a row and a key is looked for.

    A radius per row of ``right`` is a column that comes along: ``(left_key, right_key, radius)``.

    Two geometries are near when two of their edges are, or when an area holds the other one. Edges
    join edges on the grid as plain columns, so a geometry with many vertices is spread over many
    rows and no row compares all edges of one geometry with all of another.
    """
    if left_key == right_key:
        raise LayerError(f"both sides use the key {left_key!r}: rename one")
    if isinstance(left_shape, S.Geom) and isinstance(right_shape, S.Geom):
        left = require_same_srid(left, right, left_shape.column, right_shape.column)
    own = _named(radius)
    # a part that reaches nothing meets nothing, also by holding
    right = right.where(F.col(radius) >= 0) if own else right
    a, a_shape = _edges_of(left, left_key, left_shape, "_a", [])
    b, b_shape = _edges_of(right, right_key, right_shape, "_b", own)
    cell = cell or choose_cell(b, b_shape, radius)
    test = S.within(a_shape, b_shape, reach_of(radius)) if radius else S.intersects(a_shape, b_shape)
    join_options = {k: v for k, v in options.items() if k not in HIT_OPTIONS}
    if once:
        found = cut_lineage(met_groups(a, a_shape, left_key, b, b_shape, [right_key, *own], test, cell, radius, **options).distinct(), "met")
    else:
        found = grid_candidates(a, a_shape, b, b_shape, cell, radius, **join_options).where(test).select(left_key, right_key, *own)
    options = join_options
    if isinstance(left_shape, (S.Geom, S.Box)):
        areas = left
        if once:
            met = found.groupBy(left_key).agg(F.collect_set(F.struct(right_key, *own)).alias("_met"))
            areas = left.join(met, left_key, "left")
        held = _holding(areas, left_key, left_shape, right, right_key, right_shape, cell, options, own, once)
        found = found.unionByName(held.select(left_key, right_key, *own))
    if isinstance(right_shape, (S.Geom, S.Box)):
        keyed = right.withColumn("_area", F.struct(right_key, *own)) if own else right.withColumn("_area", F.col(right_key))
        held = _holding(keyed, "_area", right_shape, left, left_key, left_shape, cell, options, [])
        back = [F.col("_area")[c].alias(c) for c in (right_key, *own)] if own else [F.col("_area").alias(right_key)]
        found = found.unionByName(held.select(left_key, *back))
    return found.distinct()


def buffer_intersects_join(
    left: DataFrame,
    left_shape: S.Shape,
    key: str,
    parts: DataFrame,
    part_shape: S.Shape,
    route: str,
    radius: Radius = 50.0,
    cell: float | None = None,
    **options,
) -> DataFrame:
    """One row ``(key, route)`` per feature and route whose round buffer it meets.

    The buffer is a predicate: the exact distance to some part of the route is at most ``radius``.
    Each part may have a radius of its own: ``radius`` then names a column of ``parts``, which the rows
    ``(key, route, radius)`` show; a part whose radius is missing or below zero has no buffer. Only the
    key and the geometry travel through the join; pairs are combined before the shuffle, and dense layers need none.
    """
    return _buffer_pairs(left, left_shape, key, parts, part_shape, route, radius, cell, **options)


def _buffer_pairs(left, left_shape, key, parts, part_shape, route, radius, cell, unique=False, carry=(), **options) -> DataFrame:
    """As ``buffer_intersects_join``. ``unique``: no key is missing or comes twice, and the columns ``carry`` come along."""
    own = _named(radius)
    b = parts.select(route, *part_shape.columns, *own)
    if isinstance(left_shape, S.Geom) or isinstance(part_shape, S.Geom):
        pairs = geometry_pairs(left.select(key, *left_shape.columns), key, left_shape, b, route, part_shape, radius, cell, True, **options)
        return left.select(key, *carry).join(pairs, key) if carry else pairs
    if {c.lower() for c in carry} & {c.lower() for c in (route, *own)}:
        pairs = _buffer_pairs(left, left_shape, key, parts, part_shape, route, radius, cell, unique, **options)
        return left.select(key, *carry).join(pairs, key)
    cell = cell or choose_cell(parts, part_shape, radius)
    near = S.within(left_shape, part_shape, reach_of(radius))
    a = left.select(*dict.fromkeys([key, *left_shape.columns, *carry]))
    return met_groups(
        a, left_shape, key, b, part_shape, [route, *own], near, cell, radius, distinct=True, unique=unique, carry=tuple(carry), **options
    )


ROW = "_row"


def number_rows(df: DataFrame) -> DataFrame:
    """The rows, written, each with a number of its own: what stands for a row whatever its key is."""
    return cut_lineage(use_all_cores(df).withColumn(ROW, F.monotonically_increasing_id()), "rows")


def attach_buffers(
    df: DataFrame, shape: S.Shape, parts: DataFrame, part_shape: S.Shape, route: str, radius: Radius, cell: float | None = None, **options
) -> DataFrame:
    """Every row of ``df`` once for each route buffer it meets, with the route and, if per part, the radius.

    Rows are rows of their own: keys may repeat or be NULL.
    """
    rows = number_rows(df)
    return _buffer_pairs(rows, shape, ROW, parts, part_shape, route, radius, cell, unique=True, carry=df.columns, **options).drop(ROW)


def touch_flag(
    df: DataFrame, shape: S.Shape, parts: DataFrame, part_shape: S.Shape, route: str, radius: Radius, flag: str = "touches",
    cell: float | None = None, **options,
) -> DataFrame:
    """Does the row meet any buffer? Never NULL, one row per input row, whose key may repeat or be NULL."""
    rows = number_rows(df)
    # whatever the route: one hit is enough
    parts = parts.select(F.lit(0).alias("_any"), *part_shape.columns, *_named(radius))
    pairs = _buffer_pairs(rows, shape, ROW, parts, part_shape, "_any", radius, cell, unique=True, **options)
    hit = pairs.select(ROW).distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, ROW, "left").select(*df.columns, F.col("_hit").isNotNull().alias(flag))


def distinct_outcomes(n_left: DataFrame, n_right: DataFrame, pairs: DataFrame, name: str = "touches") -> DataFrame:
    """Distinct values of a predicate over all (left, right) combinations, without forming them.

    ``n_left`` and ``n_right`` are one-row counts of the keyed sides, ``pairs`` holds each true pair
    once: ``true`` occurs when there is a pair, ``false`` when there are fewer pairs than
    combinations.
    """
    counted = (
        pairs.agg(F.count(F.lit(1)).alias("hits")).withColumn("k", F.lit(1))
        .join(n_left.toDF("a").withColumn("k", F.lit(1)), "k")
        .join(n_right.toDF("b").withColumn("k", F.lit(1)), "k")
    )
    outcomes = F.array_compact(
        F.array(
            F.when(F.col("hits") > 0, F.lit(True)),
            F.when(F.col("hits").cast("decimal(38,0)") < F.col("a").cast("decimal(19,0)") * F.col("b"), F.lit(False)),
        )
    )
    return counted.select(F.explode(outcomes).alias(name))
