"""Closed-form planar geometry over plain double columns.

Everything here is ordinary arithmetic, so it stays inside whole-stage code generation. Squared
distances are used throughout; callers take the root once, on the rows that survive.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _zero() -> Column:
    return F.lit(0.0)


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def gap(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Distance between two closed intervals, 0 when they meet."""
    return F.greatest(lo_b - hi_a, lo_a - hi_b, _zero())


def point_point_d2(ax, ay, bx, by) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by)


def box_box_d2(a, b) -> Column:
    """Boxes are (xmin, ymin, xmax, ymax); a point is a box of size 0."""
    dx = gap(a[0], a[2], b[0], b[2])
    dy = gap(a[1], a[3], b[1], b[3])
    return dx * dx + dy * dy


def square(radius) -> Column:
    """Square of a radius, a number or a column."""
    return radius * radius if isinstance(radius, Column) else F.lit(float(radius) * float(radius))


def boxes_meet(a, b, radius=0.0) -> Column:
    return (
        (a[0] <= b[2] + radius)
        & (b[0] - radius <= a[2])
        & (a[1] <= b[3] + radius)
        & (b[1] - radius <= a[3])
    )


def point_segment_d2(px, py, x1, y1, x2, y2) -> Column:
    """Clamped projection on the segment; a zero-length segment is its end point."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, _zero()).otherwise(
        F.greatest(_zero(), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / length2))
    )
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def side(px, py, x1, y1, x2, y2) -> Column:
    """Positive left of the directed line, negative right of it, 0 on it."""
    return (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)


def segments_meet(a, b) -> Column:
    """Segments (x1, y1, x2, y2) share a point; touching and collinear overlap count.

    Two segments meet exactly when their bounding boxes meet and neither lies strictly on one
    side of the other's line. This also holds for zero-length and collinear segments.
    """
    b1, b2 = side(b[0], b[1], *a), side(b[2], b[3], *a)
    a1, a2 = side(a[0], a[1], *b), side(a[2], a[3], *b)
    boxes = (
        (F.least(a[0], a[2]) <= F.greatest(b[0], b[2]))
        & (F.least(b[0], b[2]) <= F.greatest(a[0], a[2]))
        & (F.least(a[1], a[3]) <= F.greatest(b[1], b[3]))
        & (F.least(b[1], b[3]) <= F.greatest(a[1], a[3]))
    )

    def not_one_sided(u, v):
        return (F.least(u, v) <= 0) & (F.greatest(u, v) >= 0)

    return boxes & not_one_sided(b1, b2) & not_one_sided(a1, a2)


def segment_segment_d2(a, b) -> Column:
    ends = F.least(
        point_segment_d2(a[0], a[1], *b),
        point_segment_d2(a[2], a[3], *b),
        point_segment_d2(b[0], b[1], *a),
        point_segment_d2(b[2], b[3], *a),
    )
    return F.when(segments_meet(a, b), _zero()).otherwise(ends)


def corners(box):
    xmin, ymin, xmax, ymax = box
    return [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)]


def segment_box(seg):
    x1, y1, x2, y2 = seg
    return (F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2))


def _sides(box, seg):
    """Least and greatest of ``side`` over the corners of a box: the terms of x and of y are least and greatest apart."""
    x1, y1, x2, y2 = seg
    dx, dy = x2 - x1, y2 - y1
    low, high, left, right = dx * (box[1] - y1), dx * (box[3] - y1), dy * (box[0] - x1), dy * (box[2] - x1)
    return F.least(low, high) - F.greatest(left, right), F.greatest(low, high) - F.least(left, right)


def box_meets_segment(box, seg) -> Column:
    """Bounding boxes meet and the corners do not all lie strictly on one side of the line."""
    least, greatest = _sides(box, seg)
    return boxes_meet(box, segment_box(seg)) & (least <= 0) & (greatest >= 0)


def _nearest_corner(box, seg):
    """Of the corner nearest to the line of the segment, for a box beside that line: does it project onto the segment, its
    offset times the length, and the squared length. Where it projects elsewhere, or an edge of the box is as near, an end
    of the segment is nearest to the box."""
    x1, y1, x2, y2 = seg
    dx, dy = x2 - x1, y2 - y1
    least, greatest = _sides(box, seg)
    left = least > 0
    # the corner at which the terms of x and y are both least (or both greatest)
    cx = F.when((dy >= 0) == left, box[2]).otherwise(box[0])
    cy = F.when((dx >= 0) == left, box[1]).otherwise(box[3])
    length2 = dx * dx + dy * dy
    along = (cx - x1) * dx + (cy - y1) * dy
    return (length2 > 0) & (along >= 0) & (along <= length2), F.when(left, least).otherwise(greatest), length2


def box_segment_d2(box, seg) -> Column:
    """0 when they meet; else from an end to the box, or from the nearest corner square onto the segment."""
    x1, y1, x2, y2 = seg
    lands, off, length2 = _nearest_corner(box, seg)
    least = F.least(
        box_box_d2((x1, y1, x1, y1), box),
        box_box_d2((x2, y2, x2, y2), box),
        F.when(lands, off * off / length2),
    )
    return F.when(box_meets_segment(box, seg), _zero()).otherwise(least)


def box_within_segment(box, seg, radius) -> Column:
    """Is the box at most ``radius`` from the segment? Same cases as ``box_segment_d2``, without
    division and cut short at the first that holds.

    One corner is looked at, not four: with four copies of the formula a join condition would be
    too long for the JVM to compile.
    """
    x1, y1, x2, y2 = seg
    r2 = square(radius)
    lands, off, length2 = _nearest_corner(box, seg)
    return (
        (box_box_d2((x1, y1, x1, y1), box) <= r2)
        | (box_box_d2((x2, y2, x2, y2), box) <= r2)
        | box_meets_segment(box, seg)
        | (lands & (off * off <= r2 * length2))
    )


def segment_within_segment(a, b, radius) -> Column:
    """Are two segments at most ``radius`` apart?"""
    r2 = square(radius)
    names = ("px", "py", "x1", "y1", "x2", "y2")
    ends = F.array(
        *[
            F.struct(*[c.alias(n) for n, c in zip(names, (*point, *other))])
            for point, other in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))
        ]
    )
    return F.exists(ends, lambda e: point_segment_d2(*[e[n] for n in names]) <= r2) | segments_meet(a, b)
