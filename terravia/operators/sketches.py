"""Column profiles that are kept per partition and merged, so that a reload reads only the partitions that are new.

A partition is read once and leaves one row: per column the filled rows, least and greatest value, and sketches of the
distinct values, the quantiles and the frequent values. Sketches of several partitions merge into that of all their
rows. The rows are kept in versions: a partition that is loaded again takes the place of its former row, and a load that
fails changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.sources import versions

PART, ROWS = "part", "n_rows"
#: log2 of the registers of the distinct sketch (standard error 0.8 %), size of the quantile sketch (rank error under
#: 1 %), values that the frequent sketch tracks (a value's count is exact up to rows / TRACKED).
REGISTERS, RANKS, TRACKED = 14, 400, 1000
QUARTERS = (0.25, 0.5, 0.75)


def _plain(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.BinaryType))]


def as_number(field: T.StructField, column: Column) -> Column | None:
    """The column as a number whose order is the column's, if it has one: dates as days, times as seconds."""
    if isinstance(field.dataType, T.NumericType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp").cast("double")
    return None


def partition_sketches(df: DataFrame, part: str) -> DataFrame:
    """One row for the partition ``part``, from one pass over ``df``; nested and binary columns are left out, and a zero
    is 0.0 whatever its sign."""
    found, plain = [], _plain(df)
    floats = {f.name: (F.col(f"`{f.name}`") + 0.0).cast(f.dataType) for f in plain if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)}
    df = df.withColumns(floats) if floats else df
    for i, field in enumerate(plain):
        quoted = f"`{field.name}`"
        c = F.col(quoted)
        number = as_number(field, c)
        whole = isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType))
        found.append(F.struct(
            F.lit(field.name).alias("name"),
            F.count(c).alias("filled"),
            F.min(c).alias("least"),
            F.max(c).alias("greatest"),
            F.hll_sketch_agg(c if whole else c.cast("string"), REGISTERS).alias("distinct"),
            (F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, RANKS)).alias("ranks"),
            F.expr(f"approx_top_k_accumulate({quoted}, {TRACKED}) filter (where {quoted} is not null)").alias("frequent"),
        ).alias(f"c{i}"))
    return df.agg(F.count(F.lit(1)).alias(ROWS), *found).select(F.lit(part).alias(PART), "*")


def add_partition(df: DataFrame, part: str, path: str) -> None:
    """Keep the sketches of a partition at ``path``, in place of those it had; no other partition is read.

    All partitions have the same columns. Of two loads at the same time the later one fails and may be repeated.
    """
    spark = df.sparkSession
    number = max(versions.versions(spark, path), default=0)
    row = partition_sketches(df, part)
    if number:
        kept = versions.read_version(spark, path, number)
        if [f.dataType.simpleString() for f in kept.schema] != [f.dataType.simpleString() for f in row.schema]:
            raise LayerError(f"{path} has sketches of other columns")
        row = kept.where(F.col(PART) != part).unionByName(row)
    versions.write_version(row.coalesce(1), path, base=number)


def merged_profile(spark: SparkSession, path: str, top: int = 5) -> DataFrame:
    """One row per column over all partitions: rows, NULLs, least and greatest value as text (exact), distinct values and
    quartiles (within the stated errors; quartiles of dates in days, of times in seconds), and the ``top`` most frequent
    values with their counts. A column without values has NULLs and no frequent values."""
    kept = versions.read_version(spark, path)
    names = [c for c in kept.columns if c not in (PART, ROWS)]
    entries = []
    for c in names:
        ranks = F.kll_merge_agg_double(f"{c}.ranks")
        quartiles = F.when(F.kll_sketch_get_n_double(ranks) > 0, F.kll_sketch_get_quantile_double(ranks, F.array(*map(F.lit, QUARTERS))))
        frequent = F.expr(f"approx_top_k_estimate(approx_top_k_combine({c}.frequent, {TRACKED}), {top})")
        entries.append(F.struct(
            F.first(f"{c}.name").alias("column_name"),
            (F.sum(ROWS) - F.sum(f"{c}.filled")).alias("n_nulls"),
            F.hll_sketch_estimate(F.hll_union_agg(f"{c}.distinct")).alias("n_distinct"),
            F.min(f"{c}.least").cast("string").alias("min_value"),
            F.max(f"{c}.greatest").cast("string").alias("max_value"),
            quartiles.alias("quartiles"),
            F.transform(frequent, lambda v: F.struct(v["item"].cast("string").alias("value"), v["count"].alias("n"))).alias("frequent"),
        ).alias(c))
    return kept.agg(F.sum(ROWS).alias(ROWS), *entries).select(ROWS, F.explode(F.array(*names)).alias("c")).select(
        "c.column_name", ROWS, "c.n_nulls", "c.n_distinct", "c.min_value", "c.max_value", "c.quartiles", "c.frequent"
    )
