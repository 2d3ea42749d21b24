"""Road network: dissolve by route and buffer.

A dissolved route stays in long form, one row per distinct part. Distances and intersections need
no more, and a route with a third of the network is never gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.functions import geom as G
from terravia.functions import planar
from terravia.functions.shapes import Segment


def explode_edges(df: DataFrame, route: str, geom: str = "geom") -> DataFrame:
    """Line geometries as one segment row per edge."""
    return df.select(route, F.explode(G.edges(F.col(geom))).alias("_e")).select(route, "_e.*")


def dissolve_parts(df: DataFrame, route: str, shape: Segment = Segment()) -> DataFrame:
    """Distinct parts per route: exact copies, also reversed ones, count once; missing ones never.

    The ends are put in a fixed order, so the distinct combines copies before the shuffle and its
    key is the whole part, which spreads a large route over all tasks.
    """
    x1, y1, x2, y2 = shape.ends()
    swap = (x2 < x1) | ((x2 == x1) & (y2 < y1))
    ordered = df.where(shape.present()).select(
        route,
        F.when(swap, x2).otherwise(x1).alias("x1"),
        F.when(swap, y2).otherwise(y1).alias("y1"),
        F.when(swap, x1).otherwise(x2).alias("x2"),
        F.when(swap, y1).otherwise(y2).alias("y2"),
    )
    return ordered.distinct()


def route_summary(parts: DataFrame, route: str) -> DataFrame:
    """One row per route: number of parts, total length, bounding box."""
    box = Segment().box()
    length = F.sqrt(planar.point_point_d2(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")))
    return parts.groupBy(route).agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.sum(length).alias("length"),
        F.min(box[0]).alias("xmin"), F.min(box[1]).alias("ymin"),
        F.max(box[2]).alias("xmax"), F.max(box[3]).alias("ymax"),
    )


def buffer_parts(parts: DataFrame, radius: float = 50.0) -> DataFrame:
    """Parts with their radius: the stored form of the buffers, joined by exact distance."""
    return parts.withColumn("radius", F.lit(float(radius)))


def export_buffers(parts: DataFrame, radius: float = 50.0, srid: int = 2154) -> DataFrame:
    """One capsule polygon per part, for drawing; neighbours overlap and are not dissolved."""
    ends = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    return parts.withColumn("geometry", G.capsule(*ends, radius, srid))
