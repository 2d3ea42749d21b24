"""How a layer stores its geometry, and the matching distance and intersection expressions.

Points, segments and axis-aligned boxes kept as plain double columns use closed forms; any other
pairing goes through the general geometry column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from terravia.functions import geom as G
from terravia.functions import planar


@dataclass(frozen=True)
class Point:
    x: str = "x"
    y: str = "y"

    @property
    def columns(self):
        return (self.x, self.y)

    def box(self):
        x, y = F.col(self.x), F.col(self.y)
        return (x, y, x, y)

    def geom(self) -> Column:
        return G.make_point(F.col(self.x), F.col(self.y))

    def present(self) -> Column:
        return planar.all_of(F.col(c).isNotNull() for c in self.columns)


@dataclass(frozen=True)
class Segment:
    x1: str = "x1"
    y1: str = "y1"
    x2: str = "x2"
    y2: str = "y2"

    @property
    def columns(self):
        return (self.x1, self.y1, self.x2, self.y2)

    def ends(self):
        return tuple(F.col(c) for c in self.columns)

    def box(self):
        return planar.segment_box(self.ends())

    def geom(self) -> Column:
        return G.make_segment(*self.ends())

    def present(self) -> Column:
        return planar.all_of(F.col(c).isNotNull() for c in self.columns)


@dataclass(frozen=True)
class Box:
    xmin: str = "xmin"
    ymin: str = "ymin"
    xmax: str = "xmax"
    ymax: str = "ymax"

    @property
    def columns(self):
        return (self.xmin, self.ymin, self.xmax, self.ymax)

    def box(self):
        return tuple(F.col(c) for c in self.columns)

    def geom(self) -> Column:
        return G.make_box(*self.box())

    def present(self) -> Column:
        return planar.all_of(F.col(c).isNotNull() for c in self.columns)


@dataclass(frozen=True)
class Geom:
    column: str = "geom"

    @property
    def columns(self):
        return (self.column,)

    def box(self):
        return G.bounds(F.col(self.column))

    def geom(self) -> Column:
        return F.col(self.column)

    def present(self) -> Column:
        return F.col(self.column).isNotNull()


Shape = Point | Segment | Box | Geom


def _closed_form_d2(a: Shape, b: Shape) -> Column | None:
    if isinstance(a, (Point, Box)) and isinstance(b, (Point, Box)):
        return planar.box_box_d2(a.box(), b.box())
    if isinstance(a, Point) and isinstance(b, Segment):
        return planar.point_segment_d2(F.col(a.x), F.col(a.y), *b.ends())
    if isinstance(a, Box) and isinstance(b, Segment):
        return planar.box_segment_d2(a.box(), b.ends())
    if isinstance(a, Segment) and isinstance(b, Segment):
        return planar.segment_segment_d2(a.ends(), b.ends())
    if isinstance(a, Segment) and isinstance(b, (Point, Box)):
        return _closed_form_d2(b, a)
    return None


def distance2(a: Shape, b: Shape) -> Column:
    """Squared distance of two shapes in one row; NULL when either is missing."""
    closed = _closed_form_d2(a, b)
    if closed is None:
        return G.st_distance2(a.geom(), b.geom())
    return F.when(a.present() & b.present(), closed)


def intersects(a: Shape, b: Shape) -> Column:
    """Do two shapes in one row share a point (touching counts)? NULL when either is missing."""
    if isinstance(a, (Point, Box)) and isinstance(b, (Point, Box)):
        test = planar.boxes_meet(a.box(), b.box())
    elif isinstance(a, Box) and isinstance(b, Segment):
        test = planar.box_meets_segment(a.box(), b.ends())
    elif isinstance(a, Segment) and isinstance(b, Box):
        test = planar.box_meets_segment(b.box(), a.ends())
    elif isinstance(a, Segment) and isinstance(b, Segment):
        test = planar.segments_meet(a.ends(), b.ends())
    elif isinstance(a, Point) and isinstance(b, Segment):
        ends = (F.col(a.x), F.col(a.y)) * 2
        test = planar.segments_meet(ends, b.ends())
    elif isinstance(a, Segment) and isinstance(b, Point):
        return intersects(b, a)
    else:
        return G.st_intersects(a.geom(), b.geom())
    return F.when(a.present() & b.present(), test)


def distance2_to_xy(a: Shape, px: Column, py: Column) -> Column:
    """Squared distance of a shape to a point given by two expressions."""
    if isinstance(a, Point):
        return planar.point_point_d2(F.col(a.x), F.col(a.y), px, py)
    if isinstance(a, Segment):
        return planar.point_segment_d2(px, py, *a.ends())
    if isinstance(a, Box):
        return F.when(a.present(), planar.box_box_d2(a.box(), (px, py, px, py)))
    return G.st_distance2(a.geom(), G.make_point(px, py))


def within(a: Shape, b: Shape, radius: float | Column) -> Column:
    """Are two shapes in one row at most ``radius`` apart? NULL when either is missing."""
    if isinstance(a, Box) and isinstance(b, Segment):
        return F.when(a.present() & b.present(), planar.box_within_segment(a.box(), b.ends(), radius))
    if isinstance(a, Segment) and isinstance(b, Box):
        return within(b, a, radius)
    if isinstance(a, Segment) and isinstance(b, Segment):
        return F.when(
            a.present() & b.present(), planar.segment_within_segment(a.ends(), b.ends(), radius)
        )
    return distance2(a, b) <= planar.square(radius)
