"""Projection from geographic degrees (RGF93 / WGS84) to Lambert-93 metres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from terravia.errors import LayerError
from terravia.functions.geom import PARTS_TYPE

# fixed values of the projection (GRS80, EPSG:2154)
CONE = 0.7256077650532695
ECCENTRICITY = 0.08181919104281579
SCALE = 11754255.426096004
RHO_ORIGIN = 6055612.049875985
LON_ORIGIN = 3.0
FALSE_EASTING = 700000.0
FALSE_NORTHING = 6600000.0
LAMBERT93 = 2154
GEOGRAPHIC = (4326, 4171)


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres for degrees of longitude and latitude."""
    phi = F.radians(lat)
    slant = ECCENTRICITY * F.sin(phi)
    conformal = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow(
        (1 - slant) / (1 + slant), F.lit(ECCENTRICITY / 2)
    )
    rho = SCALE * F.pow(conformal, F.lit(CONE))
    theta = CONE * F.radians(lon - LON_ORIGIN)
    return FALSE_EASTING + rho * F.sin(theta), FALSE_NORTHING + RHO_ORIGIN - rho * F.cos(theta)


def check_pair(source: int, target: int) -> bool:
    """True when coordinates must change; raises for a pair this module cannot do."""
    if target != LAMBERT93:
        raise LayerError(f"target EPSG:{target} is not supported, only EPSG:{LAMBERT93}")
    if source == LAMBERT93:
        return False
    if source in GEOGRAPHIC:
        return True
    raise LayerError(f"no projection from EPSG:{source} to EPSG:{target}")


def reproject_geom(geom: Column, source: int | None = None) -> Column:
    """Project every vertex of a geometry column to Lambert-93, each row by its own SRID.

    ``source`` is the SRID of geometries that carry none.
    """
    if source is not None:
        check_pair(source, LAMBERT93)

    def vertex(p):
        x, y = lambert93(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    parts = F.transform(
        geom["parts"],
        lambda part: F.struct(part["ring"].alias("ring"), F.transform(part["pts"], vertex).alias("pts")),
    )
    moved = F.struct(
        F.lit(LAMBERT93).alias("srid"), geom["kind"].alias("kind"), geom["dim"].alias("dim"),
        parts.cast(PARTS_TYPE).alias("parts"),
    )
    same = F.struct(
        F.lit(LAMBERT93).alias("srid"), geom["kind"].alias("kind"), geom["dim"].alias("dim"), geom["parts"].alias("parts")
    )
    own = F.coalesce(geom["srid"], F.lit(source).cast("int"))
    unknown = F.raise_error(F.concat(F.lit("no projection from EPSG:"), F.coalesce(own.cast("string"), F.lit("?"))))
    return (
        F.when(geom.isNull(), F.lit(None))
        .when(own == LAMBERT93, same)
        .when(own.isin(*GEOGRAPHIC), moved)
        .otherwise(F.struct(unknown.cast("int").alias("srid"), geom["kind"].alias("kind"), geom["dim"].alias("dim"), geom["parts"].alias("parts")))
    )
