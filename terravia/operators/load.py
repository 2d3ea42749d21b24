"""Operators of the load path: names, types, keys, projection, selection."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.functions import crs
from terravia.session import cut_lineage

DECLARED_LENGTH = "__CHAR_VARCHAR_TYPE_STRING"  # fixed value: Spark's own metadata key


def lowercase_fields(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that then collide are an error."""
    lowered = [c.lower() for c in df.columns]
    clashes = sorted(n for n, k in Counter(lowered).items() if k > 1)
    if clashes:
        raise LayerError(f"columns collide after lower-casing: {clashes}")
    return df.toDF(*lowered)


def _char_fields(schema: T.StructType):
    for field in schema:
        declared = field.metadata.get(DECLARED_LENGTH)
        if isinstance(field.dataType, (T.VarcharType, T.CharType)) or declared:
            yield field.name


def drop_string_length(df: DataFrame) -> DataFrame:
    """Turn length-limited strings into plain strings, in the type and in the field metadata."""
    limited = set(_char_fields(df.schema))
    return df.select(
        *[
            F.col(f"`{c}`").cast("string").alias(c, metadata={}) if c in limited else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def drop_geometry(df: DataFrame) -> DataFrame:
    """A layer without geometry keeps its attributes only."""
    return df.drop("geom")


def assign_gid(df: DataFrame, gid: str = "gid") -> DataFrame:
    """Unique but not dense surrogate key, with no shuffle.

    The values follow the physical layout of ``df``; write the result before using it twice, or
    use ``assign_dense_gid`` where the key must be reproducible.
    """
    return df.withColumn(gid, F.monotonically_increasing_id() + 1)


def assign_dense_gid(df: DataFrame, order_by: str, gid: str = "gid", buckets: int | None = None) -> DataFrame:
    """Dense key 1..n in the order of ``order_by``, NULL last, without a global window.

    Rows are range-partitioned and sorted by the key and then by all columns, so the order is total
    but for rows that are equal in every column: the numbers depend on the data only. Equal keys and
    NULL keys spread over ranges like any other. Each range is numbered as it is written, and shifted
    by the rows of the ranges before it (one row per range). ``buckets`` is the number of ranges.
    """
    key = F.col(f"`{order_by}`")
    others = [F.col(f"`{f.name}`") for f in df.schema if _sortable(f.dataType) and f.name != order_by]
    order = [key.asc_nulls_last(), *others]
    # columns without an order (maps) are told apart by their text
    order += [F.to_json(F.struct(f"`{f.name}`")) for f in df.schema if not _sortable(f.dataType)]
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    # the low 33 bits of this id count the rows of a partition in its sorted order
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.sortWithinPartitions(*order).withColumns({"_range": F.spark_partition_id(), "_place": place})
    stored = cut_lineage(numbered, "dense-gid")
    sizes = stored.groupBy("_range").count()
    before = F.sum("count").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    shifts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    number = (F.col("_before") + F.col("_place") + 1).cast("bigint").alias(gid)
    return stored.join(shifts, "_range").select(number, *[F.col(f"`{c}`") for c in df.columns])


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def reproject_lonlat(df: DataFrame, lon: str, lat: str, x: str = "x", y: str = "y", source: int = 4326) -> DataFrame:
    """Replace two degree columns with Lambert-93 metres."""
    if not crs.check_pair(source, crs.LAMBERT93):
        return df.withColumnsRenamed({lon: x, lat: y})
    east, north = crs.lambert93(F.col(lon), F.col(lat))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (lon, lat)]
    return df.select(*kept, east.alias(x), north.alias(y))


def reproject_layer(df: DataFrame, source: int | None = None) -> DataFrame:
    """Project the ``geom`` column to Lambert-93; a layer without geometry is returned as is.

    Every geometry is projected by its own SRID: one already in Lambert-93 stays as it is.
    ``source`` stands in where a geometry has none; an SRID that cannot be projected is an error.
    """
    if "geom" not in df.columns:
        return df
    return df.withColumn("geom", crs.reproject_geom(F.col("geom"), source))


def select_features(df: DataFrame, selection: DataFrame, key: str = "gid") -> DataFrame:
    """Only the features whose key is in ``selection``."""
    return df.join(selection.select(key), key, "left_semi")
