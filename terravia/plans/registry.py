"""Named queries with their Spark plan and, where possible, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under its operator name."""

    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return keep


def milli(value: Column) -> Column:
    """Three decimals with the same rounding in every engine."""
    return F.floor(value * 1000 + 0.5) / 1000


def milli_sql(text: str) -> str:
    return f"floor(({text}) * 1000 + 0.5) / 1000"
