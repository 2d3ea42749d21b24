"""Spatial join as an equi-join on grid cells.

Both sides are listed in the cells they may touch, joined on the cell, filtered by bounding box and
then by an exact test. A radius is one number, or the name of a column of the right side: each row then
reaches as far as it says, and its level follows from that, in one plan whatever the number of radii.

A shape that would cover many cells is listed in the few cells of a coarser level instead: level n
has cells of ``cell * 4**n``. A shape is also listed in the cells above its own, at each level that
the other side uses, and a pair meets at the coarser of its two levels. So a row gives a bounded
number of cells, whatever its size.

A cell with much join work is cut into finer cells, and both sides of it are dealt to salts: the
left rows to one set, the right rows to another, each copied to the other's. So one place holding a
large part of the data becomes many small join keys on either side. The table of such cells is
written and joined like any other; nothing about it is limited.

A pair is kept in one of the cells that both sides share, so nothing has to be told apart afterwards. For two boxes it
is the one with the lower left corner of their overlap. A segment is listed along its way; as its range of cells moves
one way from column to column, the columns in which it meets a box are neighbours, and the pair is kept in the lowest
shared cell of the first of them. Only two segments can meet in several cells.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import planar
from terravia.functions.geom import bind
from terravia.functions.shapes import Geom, Point, Segment, Shape
from terravia.session import cut_lineage

CELL_WORK = 20_000_000  # candidate pairs one task may take on before its cell is split
ROWS_PER_SALT = 100_000
MOST_CELLS = 64  # cells in which one shape is listed at its own level
BASE, DEEPEST = 4, 24  # cells of a level are so many times as wide as those below
CELL_KEYS = ("_level", "_cx", "_cy")
KEYS = (*CELL_KEYS, "_fx", "_fy", "_ls", "_rs")
STRIP = ("_low", "_plow", "_phigh")  # of a segment: the first cell in a column, the first and the last in the column before
MOST_TASKS = 5_000  # of one join; beyond that the tasks grow
TASK_WORK = 4_000_000  # candidate pairs for which a join gets one task more


@dataclass(frozen=True)
class Crowded:
    """Crowded cells: how fine each is cut and over how many salts each side is dealt."""

    table: DataFrame | None
    count: int = 0
    work: float = 0.0  # candidate pairs of all cells
    rows: float = 0.0  # rows listed in them
    cells: int = 0


Radius = float | str


def reach_of(radius: Radius) -> Column:
    """How far a row reaches; a missing one, or one below zero, reaches nothing."""
    return F.col(radius) if isinstance(radius, str) else F.lit(float(radius))


def _no_reach(radius: Radius) -> bool:
    return not isinstance(radius, str) and radius == 0


def reaching(df: DataFrame, shape: Shape, radius: Radius) -> DataFrame:
    """Rows with a geometry and a radius."""
    present = df.where(shape.present())
    return present.where(F.col(radius) >= 0) if isinstance(radius, str) else present


def cell_of(value: Column, cell) -> Column:
    size = cell if isinstance(cell, Column) else F.lit(float(cell))
    return F.floor(value / size).cast("bigint")


def size_of(cell: float, level) -> Column:
    """Cell size of a level; powers of four, so exact."""
    return F.lit(float(cell)) * F.pow(F.lit(float(BASE)), level)


def level_of(shape: Shape, cell: float, radius: Radius) -> Column:
    """The least level at which the box of the shape, grown by ``radius``, spans few cells."""
    if isinstance(shape, Point):
        extent = 2.0 * reach_of(radius)
    else:
        xmin, ymin, xmax, ymax = shape.box()
        extent = F.greatest(xmax - xmin, ymax - ymin) + 2.0 * reach_of(radius)
    # a line is followed, so it meets about as many cells as it is long; an area the square of it
    span = MOST_CELLS / 4 if isinstance(shape, Segment) else MOST_CELLS**0.5 - 2
    steps = F.ceil(F.log(F.greatest(extent / (span * cell), F.lit(1.0))) / F.log(F.lit(float(BASE))))
    return F.least(F.lit(DEEPEST), F.greatest(F.lit(0), steps)).cast("int")


def _listed(shape: Shape, cell: Column, radius: Radius) -> Column:
    """Array of cells ``struct<_cx,_cy>`` that cover the shape grown by ``radius``; with ``STRIP`` for a segment."""
    radius = reach_of(radius)
    xmin, ymin, xmax, ymax = shape.box()
    columns = F.sequence(cell_of(xmin - radius, cell), cell_of(xmax + radius, cell))
    if not isinstance(shape, Segment):
        rows = F.sequence(cell_of(ymin - radius, cell), cell_of(ymax + radius, cell))
        cells = F.transform(columns, lambda cx: F.transform(rows, lambda cy: F.struct(cx.alias("_cx"), cy.alias("_cy"))))
        return F.flatten(cells)
    x1, y1, x2, y2 = shape.ends()

    def strip(cx):
        # only the stretch of the segment near this column of cells, with a small margin
        margin = radius + cell * 1e-6
        dx, dy = x2 - x1, y2 - y1
        ta = F.when(dx == 0, F.lit(0.0)).otherwise((cx * cell - margin - x1) / dx)
        tb = F.when(dx == 0, F.lit(1.0)).otherwise(((cx + 1) * cell + margin - x1) / dx)
        t0 = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.least(ta, tb)))
        t1 = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.greatest(ta, tb)))
        ya, yb = y1 + t0 * dy, y1 + t1 * dy
        low, high = cell_of(F.least(ya, yb) - margin, cell), cell_of(F.greatest(ya, yb) + margin, cell)
        return F.struct(cx.alias("cx"), low.alias("low"), high.alias("high"))

    def cells(strips):
        def one(at, i):
            before = F.when(i > 0, F.get(strips, i - 1))
            return F.transform(
                F.sequence(at["low"], at["high"]),
                lambda cy: F.struct(
                    at["cx"].alias("_cx"), cy.alias("_cy"), at["low"].alias("_low"),
                    F.coalesce(before["low"], F.lit(1 << 62)).alias("_plow"), F.coalesce(before["high"], F.lit(1 << 62)).alias("_phigh"),
                ),
            )

        return F.flatten(F.transform(strips, one))

    return bind(F.transform(columns, strip), cells)


def levels_of(sides, cell: float) -> list[int]:
    """The levels that the sides ``(df, shape, radius)`` use: at most ``DEEPEST`` + 1 numbers."""
    asked = [reaching(df, s, r).select(level_of(s, cell, r).alias("l")) for df, s, r in sides if not (isinstance(s, Point) and _no_reach(r))]
    found = {r[0] for r in reduce(DataFrame.unionByName, asked).distinct().collect()} if asked else set()
    return sorted(found | ({0} if len(asked) < len(sides) else set()))


def list_cells(df: DataFrame, shape: Shape, cell: float, radius: Radius = 0.0, levels=(0,), own: int | None = None) -> DataFrame:
    """One row per (row, cell): its own level ``_own``, and ``_level, _cx, _cy`` at that level and at
    those of ``levels`` above it; for a segment ``STRIP`` as well. Rows without a geometry are left out.
    ``own``: the level of all rows, if it is not to follow from the shapes."""
    present = reaching(df, shape, radius).withColumn("_own", level_of(shape, cell, radius) if own is None else F.lit(own))
    above = F.filter(F.array(*[F.lit(v) for v in levels]).cast("array<int>"), lambda v: v > F.col("_own"))
    leveled = present.withColumn("_level", F.explode(F.concat(F.array("_own"), above)))
    size = size_of(cell, F.col("_level"))
    if isinstance(shape, Point) and _no_reach(radius):
        return leveled.withColumns({"_cx": cell_of(F.col(shape.x), size), "_cy": cell_of(F.col(shape.y), size)})
    exploded = leveled.withColumn("_cell", F.explode(_listed(shape, size, radius)))
    names = ("_cx", "_cy", *(STRIP if isinstance(shape, Segment) else ()))
    return exploded.withColumns({c: F.col("_cell")[c] for c in names}).drop("_cell")


def _extent(shape: Shape) -> Column:
    """The wider side of a shape's box."""
    if isinstance(shape, Point):
        return F.lit(0.0)
    xmin, ymin, xmax, ymax = shape.box()
    return F.greatest(xmax - xmin, ymax - ymin).cast("double")


def find_crowded(
    left: DataFrame, right: DataFrame, cell: float, radius: Radius, cell_work: int = CELL_WORK,
    rows_per_salt: int = ROWS_PER_SALT, left_shape: Shape = Point(), right_shape: Shape = Point(),
) -> Crowded:
    """Count both sides per cell and write down the cells that would hold up one task.

    Those are cells with much join work, and cells into which one side alone sends many rows.
    """
    keys = list(CELL_KEYS)
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"), F.avg(_extent(left_shape)).alias("_lwide"))
    b = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_nr"), F.max(reach_of(radius)).alias("_reach"), F.avg(_extent(right_shape)).alias("_rwide")
    )
    both = cut_lineage(a.join(b, keys, "full").na.fill(0, ["_nl", "_nr"]), "cells")
    pairs = F.col("_nl").cast("double") * F.col("_nr")
    much = pairs > cell_work
    work = both.where(much | (F.greatest("_nl", "_nr") > 20 * rows_per_salt))
    # a cut no finer than the radius, as the right rows are listed that far around
    size = size_of(cell, F.col("_level"))
    finest = F.least(F.lit(64.0), 2 * size / F.nullif(F.col("_reach"), F.lit(0.0)))
    # nor than the shapes are wide, as each is copied to all fine cells of its box; what then is left is dealt to salts
    for wide in ("_lwide", "_rwide"):
        finest = F.least(finest, size / F.nullif(F.col(wide), F.lit(0.0)))
    cut = F.least(finest, F.sqrt(F.greatest("_nl", "_nr") / 16)).cast("int")
    # what a cut leaves in the worst case, all rows at one spot, is dealt to salts
    per = F.lit(float(min(rows_per_salt, max(1, int(cell_work**0.5)))))
    table = work.select(
        *keys,
        F.greatest(F.lit(1), cut).alias("_cut"),
        F.greatest(F.lit(1), F.ceil(F.col("_nl") / per)).cast("int").alias("_lsalts"),
        F.greatest(F.lit(1), F.ceil(F.col("_nr") / per)).cast("int").alias("_rsalts"),
    )
    stored = cut_lineage(table, "crowded")
    n = stored.count()
    total, rows, cells = both.agg(F.sum(pairs), F.sum(F.col("_nl") + F.col("_nr")), F.count(F.lit(1))).first()
    return Crowded(stored if n else None, n, total or 0.0, float(rows or 0), cells)


def _fine(value: Column, cell_no: Column, cell: Column, cut: Column) -> Column:
    """Index 0..cut-1 of a value inside its cell; values outside are clamped, so it is monotone."""
    step = F.floor((value - cell_no * cell) / (cell / cut)).cast("int")
    return F.greatest(F.lit(0), F.least(cut - 1, step))


def spread(df: DataFrame, shape: Shape, cell: float, radius: Radius, crowded: Crowded, is_left: bool) -> DataFrame:
    """Add the fine cell and the salts; rows outside crowded cells get zeros."""
    if crowded.table is None:
        return df
    ones = {c: F.coalesce(c, F.lit(1)) for c in ("_cut", "_lsalts", "_rsalts")}
    # numbered before the join, in the order of the scan: the same when a lost task is run again
    numbered = df.withColumn("_n", F.monotonically_increasing_id())
    marked = numbered.join(crowded.table, list(CELL_KEYS), "left").withColumns(ones)
    xmin, ymin, xmax, ymax = shape.box()
    size = size_of(cell, F.col("_level"))

    def span(low, high, number):
        return F.sequence(_fine(low, number, size, F.col("_cut")), _fine(high, number, size, F.col("_cut")))

    for name, low, high, number in (
        ("_fx", xmin - reach_of(radius), xmax + reach_of(radius), F.col("_cx")),
        ("_fy", ymin - reach_of(radius), ymax + reach_of(radius), F.col("_cy")),
    ):
        least = _fine(low, number, size, F.col("_cut"))
        marked = marked.withColumn(_named(name, is_left), least).withColumn(name, F.explode(span(low, high, number)))
    mine, other = ("_ls", "_rs") if is_left else ("_rs", "_ls")
    marked = marked.withColumn(mine, F.pmod(F.xxhash64("_n"), F.col(f"{mine}alts")).cast("int"))
    copies = F.sequence(F.lit(0), F.col(f"{other}alts") - 1)
    return marked.withColumn(other, F.explode(copies)).drop("_cut", "_lsalts", "_rsalts", "_n")


def with_own(listed: DataFrame) -> DataFrame:
    """Does a listing lie on the level of its row (``_atown``)?"""
    return listed.withColumn("_atown", F.col("_level") == F.col("_own"))


ROW_NEEDS = ("_own", "_x0", "_y0", "_x1", "_y1", "_x", "_y", "_high", "_fx", "_fy")


def _named(name: str, is_left: bool) -> str:
    """The name that one side gives to what both have."""
    return ("_l" if is_left else "_r") + name[1:]


def _own_box(is_left: bool):
    return tuple(F.col(_named(c, is_left)) for c in ROW_NEEDS[1:5])


def _prepared(listed: DataFrame, shape: Shape, cell: float, radius: Radius, is_left: bool) -> DataFrame:
    """Add what the test of a pair needs of a row: is this its own level, its box grown by the radius, the lowest cells and the
    highest row of cells that the box meets. Coordinates and radius, none of which is missing by now, are marked so."""
    xmin, ymin, xmax, ymax = shape.box()
    reach, size = reach_of(radius), size_of(cell, F.col("_level"))
    low_x, low_y, high_x, high_y = (xmin, ymin, xmax, ymax) if _no_reach(radius) else (xmin - reach, ymin - reach, xmax + reach, ymax + reach)
    needs = (
        F.col("_level") == F.col("_own"), *[F.coalesce(v.cast("double"), F.lit(0.0)) for v in (low_x, low_y, high_x, high_y)],
        *[F.coalesce(cell_of(v, size), F.lit(0)) for v in (low_x, low_y, high_y)],
    )
    there = [] if isinstance(shape, Geom) else list(shape.columns)
    there += [radius] if isinstance(radius, str) else []
    kinds = dict(listed.dtypes)
    named = listed.withColumns({_named(c, is_left): v for c, v in zip(ROW_NEEDS, needs)}).drop("_own")
    return named.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(kinds[c])) for c in there if kinds[c] != "void"})


def grid_candidates(
    left: DataFrame,
    left_shape: Shape,
    right: DataFrame,
    right_shape: Shape,
    cell: float,
    radius: Radius = 0.0,
    balance: bool = True,
    cell_work: int = CELL_WORK,
    rows_per_salt: int = ROWS_PER_SALT,
    also: tuple[str, ...] = (),
    counted: tuple[list[int], Crowded] | None = None,
) -> DataFrame:
    """Pairs whose bounding boxes come within ``radius`` and that agree in the columns ``also`` (of the right side, once).
    ``counted``: the levels and crowded cells, if they are known.

    The pairs are unique unless both sides are segments, whose covers follow the lines (see
    ``needs_distinct``). Column names of both sides must differ.
    """
    same = sorted((set(left.columns) & set(right.columns)) - set(also))
    if same:
        raise LayerError(f"rename columns that both sides have: {same}")
    if cell <= 0:
        raise LayerError("the cell size must be positive")
    levels = counted[0] if counted else levels_of([(left, left_shape, 0.0), (right, right_shape, radius)], cell)
    listed_left = list_cells(left, left_shape, cell, 0.0, levels)
    listed_right = list_cells(right, right_shape, cell, radius, levels)
    crowded = counted[1] if counted else Crowded(None)
    if balance and not counted:
        crowded = find_crowded(listed_left, listed_right, cell, radius, cell_work, rows_per_salt, left_shape, right_shape)
    a = spread(_prepared(listed_left, left_shape, cell, 0.0, True), left_shape, cell, 0.0, crowded, True)
    b = spread(_prepared(listed_right, right_shape, cell, radius, False), right_shape, cell, radius, crowded, False)
    keys = [*also, *(KEYS if crowded.table is not None else CELL_KEYS)]
    if crowded.work > TASK_WORK:
        # the work follows the pairs and not the bytes: as many tasks as they need, however small the sides are
        tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, int(crowded.work // TASK_WORK) + 1))
        a, b = a.repartition(tasks, *keys), b.repartition(tasks, *keys).hint("merge")
    # what the test of a pair needs is worked out once a row: the condition of the join stays short enough to be compiled
    met = planar.boxes_meet(_own_box(True), _own_box(False))
    pairs = a.join(b, keys).where((F.col("_lown") | F.col("_rown")) & met)
    extra = (*KEYS, "_cut", *STRIP, *[_named(c, side) for c in ROW_NEEDS for side in (True, False)])
    if isinstance(left_shape, Point) or needs_distinct(left_shape, right_shape):
        return pairs.drop(*extra)
    if isinstance(right_shape, Segment) or isinstance(left_shape, Segment):
        x, y, high = (F.col(_named(c, isinstance(right_shape, Segment))) for c in ("_x", "_y", "_high"))
        first = (F.col("_cx") == x) | (F.col("_plow") > high) | (F.col("_phigh") < y)
        here = (F.col("_cy") == F.greatest("_low", y)) & first
    else:
        here = planar.all_of(F.col(f"_c{c}") == F.greatest(_named(f"_{c}", True), _named(f"_{c}", False)) for c in "xy")
    if crowded.table is not None:
        here = here & planar.all_of(F.col(c) == F.greatest(_named(c, True), _named(c, False)) for c in ("_fx", "_fy"))
    return pairs.where(here).drop(*extra)


def needs_distinct(left_shape: Shape, right_shape: Shape) -> bool:
    """Can a pair come from more than one cell? Of the cells that a box shares with another box or a segment one can be
    told apart; two segments can meet in cells that are no neighbours."""
    return isinstance(left_shape, Segment) and isinstance(right_shape, Segment)


def choose_cell(df: DataFrame, shape: Shape, radius: Radius = 0.0, rows_per_cell: int = 8) -> float:
    """Cell size from one aggregate pass: not under twice the (mean) radius or the mean box, and near
    ``rows_per_cell`` rows per cell over the extent."""
    xmin, ymin, xmax, ymax = shape.box()
    n, x0, y0, x1, y1, width, height, radius = (
        reaching(df, shape, radius)
        .select(xmin.alias("a"), ymin.alias("b"), xmax.alias("c"), ymax.alias("d"), reach_of(radius).alias("r"))
        .agg(
            F.count(F.lit(1)), F.min("a"), F.min("b"), F.max("c"), F.max("d"),
            F.avg(F.col("c") - F.col("a")), F.avg(F.col("d") - F.col("b")), F.avg("r"),
        )
        .first()
    )
    if not n:
        return 1.0
    even = (max(x1 - x0, 1.0) * max(y1 - y0, 1.0) * rows_per_cell / n) ** 0.5
    return float(max(2 * radius, 2 * max(width, height), even, 1e-6))
