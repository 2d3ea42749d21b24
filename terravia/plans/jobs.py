"""User-level jobs; each chains operators of the package."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions import shapes as S
from terravia.functions.text import this_year
from terravia.operators import dissolve, enrich, filters, layout, load, nearest, nearest_shapes, profile, quality, spatial
from terravia.sources import sinks
from terravia.sources.layers import has_geometry, require_kind

TAG_LENGTH = 40
BUFFER_RADIUS = 50.0
MANAGER = "OWN"
FLAG = "on_network"


@dataclass(frozen=True)
class Imported:
    """A stored layer: its rows, key, view, catalog table with statistics, and description."""

    layer: DataFrame
    key: quality.KeyChoice
    view: str
    table: str
    profile: DataFrame


def plain_fields(df: DataFrame) -> DataFrame:
    """Lower-case names and strings without a length limit."""
    return load.drop_string_length(load.lowercase_fields(df))


def prepare(
    df: DataFrame,
    source_srid: int = 2154,
    lonlat: tuple[str, str] | None = None,
    gid_order: str | None = None,
) -> DataFrame:
    """Lower-case names, unlimited strings, Lambert-93 coordinates and a ``gid``."""
    ready = plain_fields(df)
    if lonlat:
        ready = load.reproject_lonlat(ready, *lonlat, source=source_srid)
    elif has_geometry(ready):
        ready = load.reproject_layer(ready, source_srid)
    if "gid" in ready.columns:
        return ready
    return load.assign_dense_gid(ready, gid_order) if gid_order else load.assign_gid(ready)


def import_layer(
    df: DataFrame,
    table: str,
    path: str,
    overwrite: bool = True,
    primary_key=None,
    shape: S.Shape | None = None,
    enriched: Callable[[DataFrame], DataFrame] | None = None,
    schema: str = "layers",
    **preparation,
) -> Imported:
    """The import stage of every job.

    Prepares the layer, adds what ``enriched`` makes of it, writes it (clustered by place if it has a
    geometry), chooses its key, registers it with statistics, publishes ``<table>_view`` and
    describes it. Everything returned is read from what was stored.
    """
    ready = prepare(df, **preparation)
    if enriched is not None:
        ready = enriched(ready)
    if shape is None:
        stored = sinks.write_layer(ready, path, overwrite)
    else:
        stored = layout.write_files(ready, shape, path, overwrite)
    described = profile.geometry_profile({table: (stored, shape)})
    return Imported(
        stored, quality.choose_key(stored, primary_key), sinks.publish_view(stored, table),
        sinks.register_table(df.sparkSession, schema, table, path, stored.schema), described,
    )


def _fits(df: DataFrame, *columns: str) -> DataFrame:
    """Fail on a tag longer than its column allows, in the task that meets it."""
    for c in columns:
        text = F.col(c)
        too_long = F.raise_error(F.concat(F.lit(f"{c} is too long: "), text)).cast("string")
        df = df.withColumn(c, F.when(F.length(text) > TAG_LENGTH, too_long).otherwise(text))
    return df


def _need_field_or_shape(field: str | None, shape: S.Shape | None) -> None:
    if field is None and shape is None:
        raise LayerError("choose a field: the layer has no geometry")


def tag_centre_and_district(
    layer: DataFrame,
    lookup: DataFrame,
    centres: DataFrame | None = None,
    shape: S.Shape | None = None,
    field: str | None = None,
    key: str = "gid",
    normalise: bool = False,
    centre_shape: S.Shape | None = None,
) -> DataFrame:
    """Add ``_cei`` from the chosen field (checked against the lookup) or from the nearest centre,
    then its ``_district``. Centres are points ``x, y``, or what ``centre_shape`` says: lines or areas too."""
    _need_field_or_shape(field, shape)
    if field is not None:
        filters.require_domain(layer, field, lookup, "cei")
        tagged = filters.attribute_tag(layer, field, "_cei")
    else:
        if centre_shape is None:
            found = nearest.nearest_centre(layer, shape, centres, key=key)
        else:
            found = nearest_shapes.nearest_shape(layer, shape, centres, centre_shape)
        tagged = found.withColumnRenamed("libcei", "_cei").drop("cgid", "distance")
    tagged = _fits(tagged, "_cei")
    return _fits(
        enrich.lookup_value(tagged, lookup, "_cei", "cei", "district", "_district", normalise), "_district"
    )


def tag_district(
    layer: DataFrame,
    lookup: DataFrame,
    centres: DataFrame | None = None,
    shape: S.Shape | None = None,
    field: str | None = None,
    key: str = "gid",
    centre_shape: S.Shape | None = None,
) -> DataFrame:
    """Add ``_district`` only: from a field checked against the districts, or by nearest centre."""
    _need_field_or_shape(field, shape)
    if field is not None:
        filters.require_domain(layer, field, lookup, "district")
        return _fits(filters.attribute_tag(layer, field, "_district"), "_district")
    return tag_centre_and_district(layer, lookup, centres, shape, key=key, centre_shape=centre_shape).drop("_cei")


def import_tagged(
    df, table, path, lookup, centres=None, shape=None, field=None, normalise=False, centre_shape=None, **options
) -> Imported:
    """Import a layer with its centre and district."""

    def enriched(layer: DataFrame) -> DataFrame:
        return tag_centre_and_district(layer, lookup, centres, shape, field, normalise=normalise, centre_shape=centre_shape)

    return import_layer(df, table, path, shape=shape, **options, enriched=enriched)


def import_districts(df, table, path, lookup, centres=None, shape=None, field=None, centre_shape=None, **options) -> Imported:
    """Import a layer with its district only."""
    return import_layer(
        df, table, path, shape=shape, **options,
        enriched=lambda layer: tag_district(layer, lookup, centres, shape, field, centre_shape=centre_shape),
    )


def network_buffer(
    network: DataFrame,
    shape: S.Segment = S.Segment(),
    route: str = "lib_rte",
    radius: float = BUFFER_RADIUS,
    manager: str = MANAGER,
) -> DataFrame:
    """Buffers of one manager's routes as distinct parts with a radius."""
    managed = network.where(F.col("gestionnaire") == manager)
    return dissolve.buffer_parts(dissolve.dissolve_parts(managed, route, shape), radius)


def load_network(network: DataFrame, path: str, year: int | None = None, manager: str = MANAGER) -> DataFrame:
    """One manager's part of the network, written as the partition of its vintage."""
    managed = plain_fields(network).where(F.col("gestionnaire") == manager)
    return sinks.write_partition(managed, path, {"millesime": year or this_year()})


def store_buffers(
    network: DataFrame, path: str, route: str = "lib_rte", radius: float = BUFFER_RADIUS, manager: str = MANAGER
) -> DataFrame:
    """Dissolve and buffer a loaded network once; later jobs read what lies at ``path``."""
    layout.write_files(network_buffer(network, route=route, radius=radius, manager=manager), S.Segment(), path)
    return read_buffers(network.sparkSession, path, route)


def read_buffers(spark, path: str, route: str = "lib_rte") -> DataFrame:
    """The stored buffers: route, ends of a part, radius."""
    return spark.read.parquet(path).select(route, "x1", "y1", "x2", "y2", "radius")


def intersect_buffers(
    layer: DataFrame,
    shape: S.Shape,
    buffers: DataFrame,
    path: str,
    name: str,
    kinds: tuple[str, ...],
    partition: dict | str,
    route: str = "lib_rte",
    cell: float | None = None,
    overwrite: bool = True,
) -> DataFrame:
    """Rows of a layer with the columns of each route buffer they meet, written by partition.

    The layer name must be of one of ``kinds``. ``partition`` names the one partition that all rows belong
    to, or the column that tells a row's; either way a run replaces the partitions of the layer, also
    those left without rows, or fails without ``overwrite``. ``shape`` and the column are named in lower
    case, as the load leaves them. Every stored part has a radius of its own. Rows are rows of their own,
    whatever their key is.
    """
    kind = require_kind(name, kinds)
    layer = plain_fields(layer)
    rows = spatial.attach_buffers(layer, shape, buffers, S.Segment(), route, "radius", cell)
    if isinstance(partition, dict):
        return sinks.write_partition(rows, path, {"layer": kind, **partition}, overwrite)
    rows = rows.withColumn("layer", F.lit(kind))
    return sinks.replace_partitions(rows, path, ["layer", partition], layer.select(F.lit(kind).alias("layer"), partition), overwrite)


def commune_intersect(layer, shape, buffers, path, name, year, **options) -> DataFrame:
    """Communes per route buffer for one vintage."""
    return intersect_buffers(layer, shape, buffers, path, name, ("commune",), {"millesime": year}, **options)


def parcel_intersect(layer, shape, buffers, path, name, dep=None, column="dep", **options) -> DataFrame:
    """Parcels or address points per route buffer: of one département, or of all that ``column`` names."""
    partition = column if dep is None else {"dep": dep}
    return intersect_buffers(layer, shape, buffers, path, name, ("parcelle", "localisant"), partition, **options)


def departement_flag(
    layer: DataFrame, shape: S.Shape, buffers: DataFrame, table: str, path: str, route: str = "lib_rte",
    cell: float | None = None, flag: str = FLAG, **options,
) -> Imported:
    """Import the départements with a flag: does each meet any route buffer?"""
    require_kind(table, ("departement",))

    def flagged(ready: DataFrame) -> DataFrame:
        return spatial.touch_flag(ready, shape, buffers, S.Segment(), route, "radius", flag, cell)

    return import_layer(layer, table, path, shape=shape, enriched=flagged, **options)
