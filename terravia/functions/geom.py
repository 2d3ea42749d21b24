"""The general geometry column and its functions, as Column expressions.

A geometry is ``struct<srid, kind, dim, parts>``; ``parts`` is an array of point lists with a ring
number (0 outer or no ring, 1.. hole). Every predicate works on the list of straight edges, with a
point as a zero-length edge, plus an even-odd test when the kind is an area.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from terravia.functions import edge_pairs, planar

GEOM_TYPE = (
    "struct<srid:int,kind:string,dim:int,"
    "parts:array<struct<ring:int,pts:array<struct<x:double,y:double>>>>>"
)
PARTS_TYPE = "array<struct<ring:int,pts:array<struct<x:double,y:double>>>>"
AREA_KINDS = ("POLYGON", "MULTIPOLYGON")
LINE_KINDS = ("LINESTRING", "MULTILINESTRING")
POINT_KINDS = ("POINT", "MULTIPOINT")
KINDS = POINT_KINDS + LINE_KINDS + AREA_KINDS


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` (a let-binding)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pt(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _geom(srid, kind, parts, dim=2, valid=None) -> Column:
    built = F.struct(
        F.lit(srid).cast("int").alias("srid"),
        (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"),
        (dim if isinstance(dim, Column) else F.lit(dim)).cast("int").alias("dim"),
        parts.cast(PARTS_TYPE).alias("parts"),
    )
    return built if valid is None else F.when(valid, built)


def _part(points, ring=0) -> Column:
    return F.struct(
        (ring if isinstance(ring, Column) else F.lit(ring)).cast("int").alias("ring"),
        points.alias("pts"),
    )


def make_point(x, y, srid: int = 2154) -> Column:
    return _geom(srid, "POINT", F.array(_part(F.array(_pt(x, y)))), valid=x.isNotNull() & y.isNotNull())


def make_segment(x1, y1, x2, y2, srid: int = 2154) -> Column:
    valid = planar.all_of(c.isNotNull() for c in (x1, y1, x2, y2))
    return _geom(srid, "LINESTRING", F.array(_part(F.array(_pt(x1, y1), _pt(x2, y2)))), valid=valid)


def make_box(xmin, ymin, xmax, ymax, srid: int = 2154) -> Column:
    ring = [*planar.corners((xmin, ymin, xmax, ymax)), (xmin, ymin)]
    valid = planar.all_of(c.isNotNull() for c in (xmin, ymin, xmax, ymax))
    points = F.array(*[_pt(x, y) for x, y in ring])
    return _geom(srid, "POLYGON", F.array(_part(points)), valid=valid)


def is_area(geom: Column) -> Column:
    return geom["kind"].isin(*AREA_KINDS)


def edges(geom: Column) -> Column:
    """``array<struct<x1,y1,x2,y2>>`` over all parts and rings."""

    def edge(a, b):
        return F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        )

    def of_part(part):
        points = part["pts"]
        size = F.size(points)
        pairs = F.zip_with(F.slice(points, 1, size - 1), F.slice(points, 2, size - 1), edge)
        lone = F.transform(points, lambda p: edge(p, p))
        return F.when(size < 2, lone).otherwise(pairs)

    return F.flatten(F.transform(geom["parts"], of_part))


def _xy(e: Column):
    return (e["x1"], e["y1"], e["x2"], e["y2"])


def inside(px, py, edge_list: Column) -> Column:
    """Even-odd rule; points on the boundary are decided by the edge tests instead."""

    def crossed(e):
        turn = planar.side(px, py, *_xy(e))
        upward = e["y2"] > e["y1"]
        straddles = (e["y1"] > py) != (e["y2"] > py)
        return straddles & F.when(upward, turn > 0).otherwise(turn < 0)

    return F.size(F.filter(edge_list, crossed)) % 2 == 1


@F.arrow_udf(BooleanType())
def _intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    return edge_pairs.on_both(a, b, AREA_KINDS, edge_pairs.intersects, pa.bool_())


@F.arrow_udf(DoubleType())
def _distance2(a: pa.Array, b: pa.Array) -> pa.Array:
    return edge_pairs.on_both(a, b, AREA_KINDS, edge_pairs.distance2, pa.float64())


def st_intersects(a: Column, b: Column) -> Column:
    """True when the geometries share a point, touching included; NULL in gives NULL out."""
    return _intersects(a, b)


def st_distance2(a: Column, b: Column) -> Column:
    """Squared planar distance, 0 when the geometries meet; NULL in gives NULL out."""
    return _distance2(a, b)


def st_distance(a: Column, b: Column) -> Column:
    return F.sqrt(st_distance2(a, b))


def bounds(geom: Column):
    """Columns (xmin, ymin, xmax, ymax)."""
    points = F.flatten(F.transform(geom["parts"], lambda p: p["pts"]))
    xs, ys = points["x"], points["y"]
    return (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def st_length(geom: Column) -> Column:
    def step(total, e):
        return total + F.sqrt(planar.point_point_d2(e["x1"], e["y1"], e["x2"], e["y2"]))

    return F.when(geom.isNotNull(), F.aggregate(edges(geom), F.lit(0.0), step))


def ring_area(points: Column) -> Column:
    """Unsigned shoelace area of one closed ring, relative to its first vertex for precision."""

    def of(first):
        size = F.size(points)
        terms = F.zip_with(
            F.slice(points, 1, size - 1),
            F.slice(points, 2, size - 1),
            lambda p, q: (p["x"] - first["x"]) * (q["y"] - first["y"])
            - (q["x"] - first["x"]) * (p["y"] - first["y"]),
        )
        return F.abs(F.aggregate(terms, F.lit(0.0), lambda total, v: total + v)) / 2

    return bind(F.get(points, F.lit(0)), of)


def st_area(geom: Column) -> Column:
    def signed(total, part):
        area = ring_area(part["pts"])
        return total + F.when(part["ring"] == 0, area).otherwise(-area)

    area = F.when(is_area(geom), F.aggregate(geom["parts"], F.lit(0.0), signed)).otherwise(F.lit(0.0))
    return F.when(geom.isNotNull(), area)


def capsule(x1, y1, x2, y2, radius: float, srid: int = 2154, quadrant: int = 8) -> Column:
    """Round buffer of one segment as a polygon, ``quadrant`` edges per quarter turn."""
    half = 2 * quadrant
    ahead = F.when((x1 == x2) & (y1 == y2), F.lit(0.0)).otherwise(F.atan2(y2 - y1, x2 - x1))

    def arc(cx, cy, start):
        return F.transform(
            F.sequence(F.lit(0), F.lit(half)),
            lambda i: _pt(
                cx + radius * F.cos(start + i * F.pi() / half),
                cy + radius * F.sin(start + i * F.pi() / half),
            ),
        )

    ring = F.concat(arc(x2, y2, ahead - F.pi() / 2), arc(x1, y1, ahead + F.pi() / 2))
    closed = bind(ring, lambda r: F.concat(r, F.slice(r, 1, 1)))
    valid = planar.all_of(c.isNotNull() for c in (x1, y1, x2, y2))
    return _geom(srid, "POLYGON", F.array(_part(closed)), valid=valid)


def st_buffer(geom: Column, radius: float) -> Column:
    """Capsule per edge as one MULTIPOLYGON, not dissolved: for export, never for predicates."""
    caps = F.transform(
        edges(geom), lambda e: F.get(capsule(*_xy(e), radius)["parts"], F.lit(0))
    )
    return F.when(
        geom.isNotNull(),
        F.struct(
            geom["srid"].alias("srid"), F.lit("MULTIPOLYGON").alias("kind"),
            F.lit(2).alias("dim"), caps.cast(PARTS_TYPE).alias("parts"),
        ),
    )


def from_wkt(text: Column, srid: int = 2154) -> Column:
    """Parse WKT of the six simple kinds; extra ordinates are dropped, ``dim`` records them.

    A prefix ``SRID=n;`` says the SRID of its row; ``srid`` is that of rows without one.
    """
    prefix = F.regexp_extract(text, r"(?i)^\s*SRID\s*=\s*(\d+)\s*;", 1)
    body = F.regexp_replace(text, r"(?i)^\s*SRID\s*=\s*\d+\s*;", "")
    kind = F.upper(F.regexp_extract(body, r"^\s*([A-Za-z]+)", 1))
    area = kind.isin(*AREA_KINDS)
    lists = F.regexp_extract_all(body, F.lit(r"(\(?)\s*\(([^()]+)\)"), F.lit(2))
    openers = F.regexp_extract_all(body, F.lit(r"(\(?)\s*\(([^()]+)\)"), F.lit(1))

    def point(pair):
        ordinates = F.split(F.trim(pair), r"\s+")
        return _pt(F.get(ordinates, F.lit(0)), F.get(ordinates, F.lit(1)))

    def part(opener, coords):
        # an opening bracket right before the list starts a new outer ring
        ring = F.when(area & (opener == ""), F.lit(1)).otherwise(F.lit(0))
        return _part(F.transform(F.split(coords, ","), point), ring)

    first = F.split(F.trim(F.get(F.split(F.get(lists, F.lit(0)), ","), F.lit(0))), r"\s+")
    known = kind.isin(*KINDS) & (F.size(lists) > 0)
    # MULTIPOINT (1 2, 3 4) and MULTIPOINT ((1 2), (3 4)) both give one part per point
    single = F.transform(
        F.flatten(F.transform(lists, lambda coords: F.split(coords, ","))), lambda pair: _part(F.array(point(pair)))
    )
    parts = F.when(kind == "MULTIPOINT", single).otherwise(F.zip_with(openers, lists, part))
    built = _geom(srid, kind, parts, dim=F.size(first), valid=known)
    return built.withField("srid", F.when(prefix != "", prefix.cast("int")).otherwise(F.lit(srid)))


def from_geojson(kind: Column, coordinates: Column, srid: int = 2154) -> Column:
    """Geometry from a GeoJSON type and its ``coordinates`` kept as JSON text."""
    upper = F.upper(kind)
    depth = {"POINT": 1, "MULTIPOINT": 2, "LINESTRING": 2, "MULTILINESTRING": 3, "POLYGON": 3, "MULTIPOLYGON": 4}

    def nested(levels):
        return F.from_json(coordinates, "array<" * levels + "double" + ">" * levels)

    def points(arr):
        return F.transform(arr, lambda p: _pt(F.get(p, F.lit(0)), F.get(p, F.lit(1))))

    def rings(arr):
        return F.transform(arr, lambda r, i: _part(points(r), F.when(i == 0, 0).otherwise(1)))

    parts = (
        F.when(upper == "POINT", F.array(_part(points(F.array(nested(1))))))
        .when(upper == "MULTIPOINT", F.transform(points(nested(2)), lambda p: _part(F.array(p))))
        .when(upper == "LINESTRING", F.array(_part(points(nested(2)))))
        .when(upper == "MULTILINESTRING", F.transform(nested(3), lambda r: _part(points(r))))
        .when(upper == "POLYGON", rings(nested(3)))
        .when(upper == "MULTIPOLYGON", F.flatten(F.transform(nested(4), rings)))
    )
    first = F.size(F.split(F.regexp_extract(coordinates, r"\[([^\[\]]+)\]", 1), ","))
    known = upper.isin(*depth) & coordinates.isNotNull()
    return _geom(srid, upper, parts, dim=first, valid=known)


def to_wkt(geom: Column) -> Column:
    """WKT text of a geometry, for export."""

    def pts(part):
        return F.concat(
            F.lit("("),
            F.array_join(
                F.transform(part["pts"], lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))),
                ", ",
            ),
            F.lit(")"),
        )

    texts = F.transform(geom["parts"], pts)
    plain = F.array_join(texts, ", ")
    # a ring number of 0 opens the next polygon of a MULTIPOLYGON
    marked = F.transform(
        geom["parts"],
        lambda p, i: F.concat(
            F.when((p["ring"] == 0) & (i > 0), F.lit("), (")).when(i > 0, F.lit(", ")).otherwise(F.lit("")),
            pts(p),
        ),
    )
    wrapped = (
        F.when(geom["kind"].isin("POINT", "LINESTRING"), plain)
        .when(geom["kind"] == "MULTIPOLYGON", F.concat(F.lit("(("), F.array_join(marked, ""), F.lit("))")))
        .otherwise(F.concat(F.lit("("), plain, F.lit(")")))
    )
    return F.when(geom.isNotNull(), F.concat_ws(" ", geom["kind"], wrapped))
