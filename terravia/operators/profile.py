"""Table, column and geometry descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.functions.shapes import Box, Geom, Point, Segment, Shape
from terravia.operators.evolve import DEFAULT


def table_profile(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """One row per column in order: position, name, type, nullable, default."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable,
         str(f.metadata[DEFAULT]) if DEFAULT in f.metadata else None)
        for i, f in enumerate(df.schema, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, position int, column_name string, data_type string, nullable boolean, default_value string",
    )


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, least and greatest value as text.

    By default one aggregate pass over the table with a distinct-count sketch (2 % relative error).
    ``exact`` groups every column by value on its own: each branch reads one column, combines
    before its shuffle, and takes all five figures from the distinct values.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.BinaryType))]
    if exact:
        return reduce(DataFrame.unionByName, [_exact_column(df, c) for c in plain])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, name in enumerate(plain):
        c = F.col(f"`{name}`")
        aggs.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(c).alias("filled"),
                F.approx_count_distinct(c, 0.02).alias("n_distinct"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            ).alias(f"_{i}")
        )
    entries = F.array(*[F.col(f"_{i}") for i in range(len(plain))])
    return (
        df.agg(*aggs)
        .select("_n", F.explode(entries).alias("c"))
        .select(
            "c.column_name",
            F.col("_n").alias("n_rows"),
            (F.col("_n") - F.col("c.filled")).alias("n_nulls"),
            "c.n_distinct",
            "c.min_value",
            "c.max_value",
        )
    )


def _exact_column(df: DataFrame, name: str) -> DataFrame:
    value = F.col("v")
    values = df.select(F.col(f"`{name}`").alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return values.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count(value).alias("n_distinct"),
        F.min(value).cast("string").alias("min_value"),
        F.max(value).cast("string").alias("max_value"),
    ).select(F.lit(name).alias("column_name"), "n_rows", "n_nulls", "n_distinct", "min_value", "max_value")


# fixed values: kind, dimension of the plain-column encodings
PLAIN_KINDS = {Point: "POINT", Segment: "LINESTRING", Box: "POLYGON"}


def geometry_profile(layers: dict[str, tuple[DataFrame, Shape | None]], srid: int = 2154) -> DataFrame:
    """One row per layer: geometry kind, dimension, SRID, rows, missing geometries and extent.

    A layer without geometry has NULL in all geometry columns. Several kinds, dimensions or SRIDs in
    one layer show as a sorted list; the number of each is fixed, so the sets stay small.
    """

    def one(name, df, shape):
        if shape is None:
            none = {c: F.lit(None).cast(t).alias(c) for c, t in (
                ("kind", "string"), ("dim", "string"), ("srid", "string"), ("n_missing", "bigint"),
                ("xmin", "double"), ("ymin", "double"), ("xmax", "double"), ("ymax", "double"))}
            return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("layer"), "n_rows", *none.values()
            )
        present = shape.present()
        if isinstance(shape, Geom):
            g = F.col(shape.column)
            kind, dim, own = g["kind"], g["dim"], g["srid"]
        else:
            kind = F.when(present, F.lit(PLAIN_KINDS[type(shape)]))
            dim, own = F.when(present, F.lit(2)), F.when(present, F.lit(srid))
        box = [F.when(present, b) for b in shape.box()]
        rows = df.select(kind.alias("k"), dim.alias("d"), own.alias("s"), *[b.alias(f"b{i}") for i, b in enumerate(box)])
        return rows.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.array_join(F.sort_array(F.collect_set("k")), ",").alias("kind"),
            F.array_join(F.transform(F.sort_array(F.collect_set("d")), lambda v: v.cast("string")), ",").alias("dim"),
            F.array_join(F.transform(F.sort_array(F.collect_set("s")), lambda v: v.cast("string")), ",").alias("srid"),
            F.count_if(F.col("k").isNull()).alias("n_missing"),
            F.min("b0").alias("xmin"), F.min("b1").alias("ymin"),
            F.max("b2").alias("xmax"), F.max("b3").alias("ymax"),
        ).select(F.lit(name).alias("layer"), "n_rows", "kind", "dim", "srid", "n_missing", "xmin", "ymin", "xmax", "ymax")

    return reduce(DataFrame.unionByName, [one(n, df, s) for n, (df, s) in layers.items()])


def require_same_srid(a: DataFrame, b: DataFrame, column_a: str = "geom", column_b: str = "geom") -> DataFrame:
    """``a`` with a guard that fails on the first geometry whose SRID differs from that of ``b``.

    The SRID set of ``b`` is read once (a few integers); the guard itself runs inside the tasks.
    """
    found = [r[0] for r in b.select(F.col(column_b)["srid"].alias("s")).where("s is not null").distinct().limit(2).collect()]
    if len(found) > 1:
        raise LayerError(f"several SRIDs in one layer: {sorted(found)}")
    if not found:
        return a
    return with_srid(a, column_a, found[0])


def with_srid(df: DataFrame, column: str, srid: int) -> DataFrame:
    """``df`` with a guard that fails on the first geometry of another SRID."""
    g = F.col(column)
    bad = F.raise_error(F.concat(F.lit("mixed SRIDs: "), g["srid"].cast("string"), F.lit(f" and {srid}")))
    return df.withColumn(column, F.when(g["srid"] != srid, bad.cast(df.schema[column].dataType)).otherwise(g))
