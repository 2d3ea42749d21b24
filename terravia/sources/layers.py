"""Read vector layers into DataFrames with an optional ``geom`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.functions import geom as G
from terravia.functions.wkb import from_wkb

# fixed values: words in a layer name and the kind of layer they mean, in order of precedence
LAYER_KINDS = {
    "commune": "commune",
    "departement": "departement",
    "parcelle": "parcelle",
    "localisant": "localisant",
}


def with_geometry(df: DataFrame, encoding: str | None, columns, srid: int = 2154) -> DataFrame:
    """Turn raw geometry columns into ``geom``; ``encoding=None`` is a layer without geometry."""
    names = [columns] if isinstance(columns, str) else list(columns or [])
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise LayerError(f"geometry columns not in the layer: {missing}")
    if encoding is None:
        return df.drop(*names)
    if encoding == "xy":
        built = G.make_point(F.col(names[0]), F.col(names[1]), srid)
    elif encoding == "segment":
        built = G.make_segment(*[F.col(c) for c in names], srid=srid)
    elif encoding == "box":
        built = G.make_box(*[F.col(c) for c in names], srid=srid)
    elif encoding == "wkt":
        built = G.from_wkt(F.col(names[0]), srid)
    elif encoding == "wkb":
        built = from_wkb(F.col(names[0]), srid)
    else:
        raise LayerError(f"unknown geometry encoding {encoding!r}")
    kept = [F.col(c) for c in df.columns if c not in names and c != "geom"]
    return df.select(*kept, built.alias("geom"))


def has_geometry(df: DataFrame) -> bool:
    return "geom" in df.columns and isinstance(df.schema["geom"].dataType, T.StructType)


def read_layer(
    spark: SparkSession,
    path,
    fmt: str = "parquet",
    encoding: str | None = None,
    geometry=None,
    srid: int = 2154,
    schema=None,
    name_as: str | None = None,
    **options,
) -> DataFrame:
    """Read a layer of any geometry kind.

    ``fmt`` is parquet, orc, csv, json or geojson; ``encoding`` and ``geometry`` say how and in
    which columns the geometry is stored. Files without a geometry give an attribute-only layer.
    ``name_as`` adds the file path of each row, for ``route_by_name``.
    """
    if fmt == "geojson":
        return read_geojson(spark, path, srid=srid, properties=schema, **options)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if name_as:
        df = df.withColumn(name_as, F.col("_metadata.file_path"))
    return with_geometry(df, encoding, geometry, srid) if geometry else df


def read_geojson(
    spark: SparkSession, path, properties: str, srid: int = 4326, lines: bool = False
) -> DataFrame:
    """GeoJSON as attributes plus ``geom``.

    ``lines=True`` reads one feature per line and splits large files; a FeatureCollection is one
    JSON document, so each file is one task. ``properties`` is the DDL schema of the attributes.
    """
    fields = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(properties))
    # coordinates stay JSON text here, their depth depends on the kind
    feature = f"type string, geometry struct<type:string,coordinates:string>, properties struct<{fields}>"
    if lines:
        features = spark.read.schema(feature).json(path)
    else:
        collection = spark.read.option("multiLine", True).schema(
            T.StructType([T.StructField("features", T.ArrayType(T.StructType.fromDDL(feature)))])
        ).json(path)
        features = collection.selectExpr("inline(features)")
    geom = G.from_geojson(F.col("geometry.type"), F.col("geometry.coordinates"), srid)
    return features.select("properties.*", geom.alias("geom"))


def layer_kind(name: Column, kinds=tuple(LAYER_KINDS.values())) -> Column:
    """First kind, of those asked for, that the last path segment of a name holds; NULL when none does."""
    last = F.lower(F.element_at(F.split(name, "/"), -1))
    fits = [F.when(last.contains(word), kind) for word, kind in LAYER_KINDS.items() if kind in kinds]
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def route_by_name(df: DataFrame, name: str, kinds=tuple(LAYER_KINDS.values())) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted with ``kind``, quarantined) by the layer name they carry."""
    tagged = df.withColumn("kind", layer_kind(F.col(name), kinds))
    return tagged.where(F.col("kind").isNotNull()), tagged.where(F.col("kind").isNull())


def require_kind(name: str, kinds) -> str:
    """Kind of one named layer, by the same rule; a name that does not fit the job is an error."""
    last = name.split("/")[-1].lower()
    for word, kind in LAYER_KINDS.items():
        if kind in kinds and word in last:
            return kind
    raise LayerError(f"layer {name!r} is not one of: {', '.join(kinds)}")
