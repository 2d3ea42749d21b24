"""Attribute tagging, domain checks and capability sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.errors import LayerError

SHOWN = 50


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise LayerError(f"column {column!r} is not one of {df.columns}")


def attribute_tag(df: DataFrame, field: str, target: str) -> DataFrame:
    """Fill ``target`` from a chosen column."""
    require_column(df, field)
    return df.withColumn(target, F.col(field).cast("string"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column that must exist; NULL counts as a value."""
    require_column(df, column)
    return df.select(column).distinct()


def domain_check(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Distinct values whose upper case is not in the domain, NULL included. Empty means valid."""
    values = distinct_values(df, column).withColumn("_key", F.upper(F.col(column).cast("string")))
    known = domain.select(F.col(domain_column).alias("_key")).distinct()
    return values.join(known, "_key", "left_anti").select(column)


def require_domain(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> None:
    """Raise when ``domain_check`` finds anything: its number of values and the first of them.

    All of them are what ``domain_check`` returns.
    """
    bad = domain_check(df, column, domain, domain_column)
    shown = [r[0] for r in bad.orderBy(F.col(column).asc_nulls_last()).limit(SHOWN + 1).collect()]
    if shown:
        n = bad.count() if len(shown) > SHOWN else len(shown)
        more = f", the first of {n} (see domain_check)" if n > SHOWN else ""
        raise LayerError(f"{n} values of {column!r} not in the reference list: {shown[:SHOWN]}{more}")


def capability_sets(grants: DataFrame, keys, privilege: str, known) -> DataFrame:
    """One row per object with the sorted array ``privileges`` of those it holds.

    One boolean per known privilege is aggregated, so the map side combines and no list is built
    from rows, however many grants an object has.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    flags = [
        F.max(F.when(F.col(privilege) == p, F.lit(p))).alias(f"_p{i}") for i, p in enumerate(sorted(known))
    ]
    held = F.array_compact(F.array(*[F.col(f"_p{i}") for i in range(len(flags))]))
    return grants.groupBy(*keys).agg(*flags).select(*keys, held.alias("privileges"))


def holds_all(privileges: Column, wanted) -> Column:
    """Does the array contain every wanted value? An empty request holds."""
    wanted = list(wanted)
    if not wanted:
        return F.lit(True)
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), privileges)) == 0


def holds(privileges: Column, wanted: str) -> Column:
    return F.array_contains(privileges, wanted)


def with_capabilities(sets: DataFrame, wanted, **equals) -> DataFrame:
    """Rows that hold all wanted privileges, optionally with equal values in other columns."""
    kept = sets.where(holds_all(F.col("privileges"), wanted))
    for column, value in equals.items():
        if value is not None:
            require_column(sets, column)
            kept = kept.where(F.col(column) == value)
    return kept
