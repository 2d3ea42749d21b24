"""File layout by place, so that box filters and spatial joins read few files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravia.functions.shapes import Shape
from terravia.operators.grid import cell_of


def interleave(cx: Column, cy: Column, bits: int = 20) -> Column:
    """Interleaved-bit code of two cell numbers, so near cells get near codes."""
    mask = F.lit((1 << bits) - 1)
    ux, uy = cx.bitwiseAND(mask), cy.bitwiseAND(mask)

    def bit(value, i, shift):
        return F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1)), 2 * i + shift)

    return reduce(lambda a, b: a.bitwiseOR(b), [bit(v, i, s) for i in range(bits) for v, s in ((ux, 0), (uy, 1))])


def add_cells(df: DataFrame, shape: Shape, cell: float, coarse: int = 16) -> DataFrame:
    """Add the cell of the lower left corner, its interleaved code and the coarse partition cell."""
    xmin, ymin, *_ = shape.box()
    cx, cy = cell_of(xmin, cell), cell_of(ymin, cell)
    return df.withColumns(
        {
            "cx": cx,
            "cy": cy,
            "zcode": interleave(cx, cy),
            "coarse_x": F.floor(cx / coarse).cast("bigint"),
            "coarse_y": F.floor(cy / coarse).cast("bigint"),
        }
    )


def cluster(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Sort files by place. The full row hash splits one crowded cell over several partitions."""
    keys = ["zcode", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions("zcode")


def write_grid(
    df: DataFrame, shape: Shape, cell: float, path: str, coarse: int = 16, overwrite: bool = True
) -> DataFrame:
    """Write a layer clustered by cell and partitioned by coarse cell.

    Beside it lies one row on the layout: the cell sizes, and the largest extent of a geometry right
    and up of its lower left corner, which a box filter must reach back by.
    """
    spark = df.sparkSession
    clustered = cluster(add_cells(df, shape, cell, coarse))
    clustered.write.mode("overwrite" if overwrite else "errorifexists").partitionBy("coarse_x", "coarse_y").parquet(path)
    stored = _read(spark, path, clustered.schema)
    xmin, ymin, xmax, ymax = shape.box()
    reach = [F.coalesce(F.max(v), F.lit(0.0)).alias(n) for v, n in ((xmax - xmin, "reach_x"), (ymax - ymin, "reach_y"))]
    about = stored.where(shape.present()).agg(*reach).select(F.lit(float(cell)).alias("cell"), F.lit(coarse).alias("coarse"), "*")
    about.write.mode("overwrite").parquet(_about(path))
    return stored


FINE = 16.0  # metres; the code of a place has 20 bits a side, so files of any size are cut along one curve


def write_files(df: DataFrame, shape: Shape, path: str, overwrite: bool = True) -> DataFrame:
    """Write a layer in files along a space-filling curve, with a manifest of what lies in each.

    How many files there are follows from the bytes: Spark merges small ranges and keeps the rest (its
    advisory partition size). The manifest, beside the folder, has a row per file: rows, rows with a
    geometry and their box. Rows without a geometry come first.
    """
    xmin, ymin, *_ = shape.box()
    code = interleave(cell_of(xmin, FINE), cell_of(ymin, FINE))
    keys = [F.when(shape.present(), code), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(keys[0])
    ranged.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    stored = df.sparkSession.read.schema(ranged.schema).parquet(path)
    box = [F.when(shape.present(), v).alias(n) for n, v in zip(BOX, shape.box())]
    described = stored.select(F.input_file_name().alias("file"), *box).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count("xmin").alias("placed"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )
    described.write.mode("overwrite").parquet(_files(path))
    return stored


BOX = ("xmin", "ymin", "xmax", "ymax")


def _files(path: str) -> str:
    return path.rstrip("/") + ".files"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of a layer written by ``write_files``: ``file, rows, placed`` and the box."""
    return spark.read.parquet(_files(path))


def read_files(spark: SparkSession, path: str, shape: Shape, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose geometry's box meets the given one, from the files that the manifest names; no others are opened."""
    near = (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)
    files = [r["file"] for r in manifest(spark, path).where(near).select("file").collect()]
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    x0, y0, x1, y1 = shape.box()
    return rows.where(shape.present() & (x0 <= xmax) & (x1 >= xmin) & (y0 <= ymax) & (y1 >= ymin))


def _about(path: str) -> str:
    return path.rstrip("/") + ".layout"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_box(spark: SparkSession, path: str, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows of a written layer whose geometry may meet the box; rows that do are all among them.

    Prunes coarse partitions, then row groups by cell number.
    """
    about = spark.read.parquet(_about(path)).first()
    cell, coarse = about["cell"], about["coarse"]
    low_x, high_x = int((xmin - about["reach_x"]) // cell), int(xmax // cell)
    low_y, high_y = int((ymin - about["reach_y"]) // cell), int(ymax // cell)
    return spark.read.option("basePath", path).parquet(path).where(
        F.col("coarse_x").between(low_x // coarse, high_x // coarse)
        & F.col("coarse_y").between(low_y // coarse, high_y // coarse)
        & F.col("cx").between(low_x, high_x)
        & F.col("cy").between(low_y, high_y)
    )
