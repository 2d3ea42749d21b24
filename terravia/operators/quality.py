"""Constraint checks as jobs that return the violating rows; an empty result passes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.operators.filters import require_column


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _any_null(keys) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing


def check_primary_key(df: DataFrame, keys) -> DataFrame:
    """Key values that are repeated or hold a NULL, with their row count ``n``."""
    keys = _keys(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) | _any_null(keys))


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Repeated key values; NULLs may repeat."""
    keys = _keys(keys)
    counted = df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def check_not_null(df: DataFrame, columns) -> DataFrame:
    return df.where(_any_null(_keys(columns)))


def check_foreign_key(df: DataFrame, keys, parent: DataFrame, parent_keys) -> DataFrame:
    """Rows whose key is not in the parent; a key with a NULL passes."""
    keys, parent_keys = _keys(keys), _keys(parent_keys)
    wanted = parent.select(*[F.col(p).alias(f"_{i}") for i, p in enumerate(parent_keys)])
    on = [df[k] == wanted[f"_{i}"] for i, k in enumerate(keys)]
    return df.where(~_any_null(keys)).join(wanted, on, "left_anti")


def check_predicate(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; an unknown result passes."""
    return df.where(~condition)


def length_guard(df: DataFrame, column: str, limit: int = 40) -> DataFrame:
    """Rows whose text is longer than the column may hold (an error, never a truncation)."""
    require_column(df, column)
    return df.where(F.length(F.col(column)) > limit)


@dataclass(frozen=True)
class KeyChoice:
    key: tuple[str, ...]
    reason: str | None


def choose_key(df: DataFrame, candidate, fallback: str = "gid") -> KeyChoice:
    """The candidate when it can be a primary key, else the fallback and the reason."""
    if not candidate:
        return KeyChoice((fallback,), None)
    keys = _keys(candidate)
    for k in keys:
        if k not in df.columns:
            return KeyChoice((fallback,), f"column {k!r} does not exist")
    broken = check_primary_key(df, keys).limit(1).collect()
    if broken:
        return KeyChoice((fallback,), f"{keys} is repeated or NULL, for example {tuple(broken[0])[:-1]}")
    return KeyChoice(tuple(keys), None)
