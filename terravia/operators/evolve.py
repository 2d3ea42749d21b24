"""Schema changes as rewrites: every step maps a DataFrame to a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.functions.geom import GEOM_TYPE, KINDS
from terravia.operators.filters import require_column

DEFAULT = "default"


def add_column(df: DataFrame, name: str, dtype: str, default=None) -> DataFrame:
    if name in df.columns:
        raise LayerError(f"column {name!r} already exists")
    return df.withColumn(name, F.lit(default).cast(dtype))


def drop_column(df: DataFrame, name: str) -> DataFrame:
    require_column(df, name)
    return df.drop(name)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    require_column(df, old)
    if new != old and new in df.columns:
        raise LayerError(f"column {new!r} already exists")
    return df.withColumnRenamed(old, new)


def set_type(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Cast a column; under ANSI rules a value that does not fit is an error."""
    require_column(df, name)
    return df.withColumn(name, F.col(name).cast(dtype))


def set_default(df: DataFrame, name: str, default) -> DataFrame:
    """Record a default for rows appended later (``None`` drops it); existing rows do not change."""
    require_column(df, name)
    kept = {k: v for k, v in df.schema[name].metadata.items() if k != DEFAULT}
    if default is not None:
        kept[DEFAULT] = default
    return df.withMetadata(name, kept)


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows; columns they lack take the recorded default, else NULL."""
    extra = [c for c in new.columns if c not in df.columns]
    if extra:
        raise LayerError(f"columns not in the table: {extra}")
    filled = new.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in new.columns
            else F.lit(f.metadata.get(DEFAULT)).cast(f.dataType).alias(f.name)
            for f in df.schema
        ]
    )
    return df.unionByName(filled)


def add_geometry_column(
    df: DataFrame, name: str = "geom", kind: str = "GEOMETRY", srid: int = -1, dim: int = 2
) -> DataFrame:
    """Add an empty typed geometry column; its kind, SRID and dimension are field metadata."""
    if name in df.columns:
        raise LayerError(f"column {name!r} already exists")
    if kind not in (*KINDS, "GEOMETRY"):
        raise LayerError(f"unknown geometry kind {kind!r}")
    column = F.lit(None).cast(GEOM_TYPE)
    return df.withColumn(name, column).withMetadata(name, {"kind": kind, "srid": srid, "dim": dim})


def drop_geometry_column(df: DataFrame, name: str = "geom") -> DataFrame:
    require_column(df, name)
    if not isinstance(df.schema[name].dataType, T.StructType):
        raise LayerError(f"column {name!r} is not a geometry")
    return df.drop(name)


def evolve(df: DataFrame, steps) -> DataFrame:
    """Apply ``(function, *arguments)`` steps in order."""
    return reduce(lambda acc, step: step[0](acc, *step[1:]), steps, df)
