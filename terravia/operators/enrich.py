"""Attribute updates from another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.operators.filters import require_column
from terravia.operators.joins import lookup_join


def _one_row_per_key(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup folded to one row per key with the number of rows seen; combines on the map side."""
    return (
        lookup.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(F.col(value).alias("v")))["v"].alias("_value"))
    )


def _single(message: str):
    """The looked-up value; a key met in two or more rows fails when a row asks for it."""
    return F.when(F.col("_rows") > 1, F.raise_error(F.concat(F.lit(message), F.col("_key").cast("string")))).otherwise(
        F.col("_value")
    )


def update_from(
    df: DataFrame, source: DataFrame, key: str, target: str, value: str, source_key: str | None = None
) -> DataFrame:
    """Set ``target`` from the matching source row; rows without a match keep their value."""
    require_column(df, target)
    unique = _one_row_per_key(source, source_key or key, value)
    joined = lookup_join(df, F.col(key), unique, "_key")
    new = F.when(F.col("_rows").isNotNull(), _single("several source rows for key ")).otherwise(F.col(target))
    return joined.select(*[new.alias(c) if c == target else F.col(f"`{c}`") for c in df.columns])


def lookup_value(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    key: str,
    value: str,
    target: str,
    normalise: bool = False,
) -> DataFrame:
    """Add ``target`` looked up by ``on``: NULL when absent, an error on a key with two rows.

    ``normalise=True`` compares in upper case; by default the value is compared as it is.
    """
    unique = _one_row_per_key(lookup, key, value)
    joined = lookup_join(df, F.upper(on) if normalise else F.col(on), unique, "_key")
    kept = [F.col(f"`{c}`") for c in df.columns if c != target]
    return joined.select(*kept, _single("several lookup rows for key ").alias(target))


def overlay(base: DataFrame, richer: DataFrame, keys, columns) -> DataFrame:
    """Take ``columns`` from the richer rows where they are present, by key and not by position.

    A key met in two or more richer rows fails when a base row asks for it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = F.struct(*[F.col(c).alias(f"_top_{c}") for c in columns])
    top = richer.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(values).alias("_value"))
    joined = base.join(top, keys, "left")
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    failed = F.raise_error(F.concat(F.lit("several richer rows for key "), named))
    single = F.when(F.col("_rows") > 1, failed).otherwise(F.col("_value"))
    joined = joined.withColumn("_value", single)
    return joined.select(
        *[F.coalesce(F.col("_value")[f"_top_{c}"], F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    )
