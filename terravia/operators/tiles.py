"""Stored layers in balanced tiles, and joins to them that leave the layer where it lies.

A layer is cut into strips and each strip into tiles, at quantiles of a bounded sample, so that tiles hold about as many
rows each and follow the data instead of a fixed cell. A tile that would be too full, as one place can be, is dealt to
several by row hash. The layer is stored as a bucketed table by tile, and a manifest has the rows and the box of every
tile. For a join, the rows of the other side are sent to the tiles whose box they may meet; the stored side is read
bucket by bucket and never shuffled.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import planar
from terravia.functions import shapes as S
from terravia.operators.grid import Radius, choose_cell, grid_candidates, needs_distinct, reach_of
from terravia.operators.spatial import grid_join
from terravia.session import cut_lineage

TILE = "tile"
TILE_ROWS = 500_000
SAMPLE = 2_000_000  # rows of the layer from which the cuts are made; two numbers of each reach the driver
MOST_TILES = 65_536
TILES_PER_BUCKET = 4
BOX = S.Box("_tx0", "_ty0", "_tx1", "_ty1")
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def _literal(value, kind: str) -> Column:
    """Bounded numbers as one constant."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _position(cuts: Column, n: int, value: Column) -> Column:
    """How many of at most ``n`` rising cuts are at most ``value``, by halving."""
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(n + 1)))))

    def halve(span, _):
        middle = F.floor((span["a"] + span["b"]) / 2).cast("int")
        left = F.coalesce(F.get(cuts, middle) <= value, F.lit(False))
        done = span["a"] >= span["b"]
        return F.struct(
            F.when(~done & left, middle + 1).otherwise(span["a"]).alias("a"), F.when(~done & ~left, middle).otherwise(span["b"]).alias("b")
        )

    return F.aggregate(steps, F.struct(F.lit(0).alias("a"), F.size(cuts).alias("b")), halve, lambda span: span["a"])


def _cuts(places: np.ndarray, rows: int, tile_rows: int):
    """Strips at quantiles of x, tiles at quantiles of y inside each, and to how many each tile is dealt."""
    wanted = min(MOST_TILES, max(1, math.ceil(rows / tile_rows)))
    strips = max(1, round(math.sqrt(wanted)))
    per_strip = max(1, math.ceil(wanted / strips))
    x_cuts = np.quantile(places[:, 0], np.arange(1, strips) / strips) if len(places) else np.empty(0)
    strip = np.searchsorted(x_cuts, places[:, 0], side="right")
    y_cuts, dealt = [], []
    for s in range(strips):
        ys = places[strip == s, 1]
        cuts = np.quantile(ys, np.arange(1, per_strip) / per_strip) if len(ys) else np.empty(0)
        held = np.bincount(np.searchsorted(cuts, ys, side="right"), minlength=per_strip)
        y_cuts.append(cuts.tolist())
        dealt.append([max(1, round(int(h) / max(len(places), 1) * rows / tile_rows)) for h in held])
    return x_cuts.tolist(), y_cuts, dealt, per_strip


def add_tiles(df: DataFrame, shape: S.Shape, tile_rows: int = TILE_ROWS, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """The rows with their ``tile``, and how many tiles there are; rows without a geometry have the tile -1.

    A row belongs to the tile of its box's centre.
    """
    if TILE in df.columns:
        raise LayerError(f"the layer already has a column {TILE!r}")
    xmin, ymin, xmax, ymax = shape.box()
    x, y = (xmin + xmax) / 2, (ymin + ymax) / 2
    placed = df.where(shape.present())
    rows = placed.count()
    some = placed.select(x.alias("x"), y.alias("y")).sample(min(1.0, sample / max(rows, 1)), seed=11).toArrow()
    places = np.stack([some.column(c).to_numpy() for c in ("x", "y")], 1) if some.num_rows else np.empty((0, 2))
    x_cuts, y_cuts, dealt, per_strip = _cuts(places, rows, tile_rows)
    strip = _position(_literal(x_cuts, "array<double>"), len(x_cuts), x)
    in_strip = _position(F.get(_literal(y_cuts, "array<array<double>>"), F.col("_strip")), per_strip, y)
    flat = [n for row in dealt for n in row]
    first = np.concatenate(([0], np.cumsum(flat)[:-1])).tolist()
    number = F.col("_strip") * per_strip + F.col("_cut")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.get(_literal(flat, "array<int>"), number))
    cut = df.withColumn("_strip", F.when(shape.present(), strip)).withColumn("_cut", in_strip)
    tile = F.when(shape.present(), F.get(_literal(first, "array<int>"), number) + salt).otherwise(-1).cast("int")
    return cut.withColumn(TILE, tile).drop("_strip", "_cut"), sum(flat)


def write_tiles(
    df: DataFrame, shape: S.Shape, table: str, path: str, tile_rows: int = TILE_ROWS, sample: int = SAMPLE, buckets: int | None = None
) -> DataFrame:
    """Store a layer as the table ``table`` at ``path``, bucketed by tile, with the manifest of its tiles beside it.

    A table of that name is replaced.
    """
    tiled, n = add_tiles(df, shape, tile_rows, sample)
    buckets = buckets or max(1, math.ceil(n / TILES_PER_BUCKET))
    # dealt as the buckets are, so a task writes one file
    tiled.repartition(buckets, TILE).write.mode("overwrite").option("path", path).bucketBy(buckets, TILE).saveAsTable(table)
    stored = df.sparkSession.table(table)
    box = [F.when(shape.present(), v).alias(c) for c, v in zip(BOX.columns, shape.box())]
    about = stored.select(TILE, *box).groupBy(TILE).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_tx0").alias("_tx0"), F.min("_ty0").alias("_ty0"), F.max("_tx1").alias("_tx1"), F.max("_ty1").alias("_ty1")
    )
    about.write.mode("overwrite").parquet(path.rstrip("/") + ".tiles")
    return stored


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The tiles of a stored layer: ``tile, rows`` and the box of their geometries."""
    return spark.read.parquet(path.rstrip("/") + ".tiles")


def tile_join(
    spark: SparkSession,
    table: str,
    path: str,
    shape: S.Shape,
    right: DataFrame,
    right_shape: S.Shape,
    radius: Radius = 0.0,
    cell: float | None = None,
) -> DataFrame:
    """Pairs of a stored layer and ``right`` at most ``radius`` apart (sharing a point, for 0), the columns of both.

    Only ``right`` moves: each of its rows goes to the tiles that it may meet, and there meets the rows of its cells.
    The setting ``CO_PARTITION`` of the session is turned off, so that rows dealt by tile may be joined by tile and cell.
    """
    spark.conf.set(CO_PARTITION, "false")
    tiles = manifest(spark, path).where("_tx0 is not null").select(TILE, *BOX.columns)
    meets = planar.boxes_meet(BOX.box(), right_shape.box(), reach_of(radius))
    mine = right.withColumn("_rn", F.monotonically_increasing_id()) if needs_distinct(shape, right_shape) else right
    placed = cut_lineage(grid_join(tiles, BOX, mine, right_shape, meets, radius=radius).drop(*BOX.columns), "placed")
    cell = cell or choose_cell(right, right_shape, radius)
    near = S.within(shape, right_shape, reach_of(radius)) if isinstance(radius, str) or radius else S.intersects(shape, right_shape)
    layer = spark.table(table)
    if not needs_distinct(shape, right_shape):
        pairs = grid_candidates(layer, shape, placed, right_shape, cell, radius, balance=False, also=(TILE,))
        return pairs.where(near).drop(TILE)
    # a line is listed along its way, so a pair can be found twice, but always in one tile
    numbered = layer.withColumn("_ln", F.monotonically_increasing_id())
    pairs = grid_candidates(numbered, shape, placed, right_shape, cell, radius, balance=False, also=(TILE,)).where(near)
    return pairs.dropDuplicates([TILE, "_ln", "_rn"]).drop(TILE, "_ln", "_rn")
