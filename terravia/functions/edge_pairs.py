"""Predicates on two general geometries, for Arrow batches: all edges of the one against all of the other in numpy.

The formulas are those of ``planar``, term by term, so plain columns and general geometries agree to the last digit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PAIRS = 1 << 18  # pairs of edges that are compared at once


@dataclass
class Edges:
    """The edges of the geometries of a batch, and the first point of every part that has one."""

    ends: tuple[np.ndarray, ...]
    first: np.ndarray  # where the edges of each geometry begin, one more entry at the end
    starts: tuple[np.ndarray, np.ndarray]
    first_start: np.ndarray
    area: np.ndarray


def edges_of(geoms: pa.StructArray, areas: tuple[str, ...]) -> Edges:
    """The edges of geometries that are all there; a lone point is an edge without length."""
    kind, parts = geoms.field("kind"), geoms.field("parts")
    at = parts.offsets.to_numpy()
    points = parts.values.slice(at[0], at[-1] - at[0]).field("pts")
    at = at - at[0]
    spot = points.offsets.to_numpy()
    xy = points.values
    x, y = (xy.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    size, begin = np.diff(spot), spot[:-1]
    n = np.where(size >= 2, size - 1, size)
    total = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(n)), n)
    i = begin[owner] + np.arange(total[-1]) - total[owner]
    j = np.where(size[owner] >= 2, i + 1, i)
    filled = size > 0
    held = begin[filled]
    before = np.concatenate(([0], np.cumsum(filled)))
    return Edges(
        (x[i], y[i], x[j], y[j]), total[at], (x[held], y[held]), before[at],
        np.isin(kind.to_numpy(zero_copy_only=False), areas),
    )


def _cross(first: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(geometry, i, j) for all items i of a geometry on one side and j on the other, in pieces of about ``PAIRS``."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = np.diff(other)[owner]
    total = np.concatenate(([0], np.cumsum(n)))
    low = 0
    while low < len(owner):
        high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(low, high), n[low:high])
        j = other[owner[i]] + np.arange(total[low], total[high]) - total[i]
        if len(i):
            yield owner[i], i, j
        low = high


def _side(px, py, s):
    return (s[2] - s[0]) * (py - s[1]) - (s[3] - s[1]) * (px - s[0])


def _point_segment_d2(px, py, s):
    dx, dy = s[2] - s[0], s[3] - s[1]
    length2 = dx * dx + dy * dy
    some = length2 != 0
    t = np.where(some, ((px - s[0]) * dx + (py - s[1]) * dy) / np.where(some, length2, 1.0), 0.0)
    t = np.maximum(0.0, np.minimum(1.0, t))
    ex, ey = px - (s[0] + t * dx), py - (s[1] + t * dy)
    return ex * ex + ey * ey


def _meet(a, b):
    b1, b2, a1, a2 = _side(b[0], b[1], a), _side(b[2], b[3], a), _side(a[0], a[1], b), _side(a[2], a[3], b)
    boxes = (
        (np.minimum(a[0], a[2]) <= np.maximum(b[0], b[2])) & (np.minimum(b[0], b[2]) <= np.maximum(a[0], a[2]))
        & (np.minimum(a[1], a[3]) <= np.maximum(b[1], b[3])) & (np.minimum(b[1], b[3]) <= np.maximum(a[1], a[3]))
    )
    return boxes & (np.minimum(b1, b2) <= 0) & (np.maximum(b1, b2) >= 0) & (np.minimum(a1, a2) <= 0) & (np.maximum(a1, a2) >= 0)


def _holds(outer: Edges, inner: Edges) -> np.ndarray:
    """Does the area hold the first point of any part of the other geometry (even-odd rule)?"""
    held = np.zeros(len(outer.area), bool)
    # geometries that are no areas have no edges to cross
    wanted = np.where(outer.area, np.diff(inner.first_start), 0)
    first = np.concatenate(([0], np.cumsum(wanted)))
    own = np.flatnonzero(np.repeat(outer.area, np.diff(inner.first_start)))
    for geometry, i, j in _cross(first, outer.first):
        px, py = (c[own[i]] for c in inner.starts)
        s = tuple(c[j] for c in outer.ends)
        turn = _side(px, py, s)
        crossed = ((s[1] > py) != (s[3] > py)) & np.where(s[3] > s[1], turn > 0, turn < 0)
        new = np.flatnonzero(np.append(True, np.diff(i) != 0))
        odd = np.add.reduceat(crossed.astype(np.int64), new) % 2 == 1
        held[geometry[new[odd]]] = True
    return held


def intersects(a: Edges, b: Edges) -> np.ndarray:
    """Does each geometry share a point with the one beside it?"""
    met = _holds(a, b) | _holds(b, a)
    for geometry, i, j in _cross(a.first, b.first):
        met[geometry[_meet(tuple(c[i] for c in a.ends), tuple(c[j] for c in b.ends))]] = True
    return met


def distance2(a: Edges, b: Edges) -> np.ndarray:
    """Squared distances, 0 where the geometries meet, NaN where one has no points."""
    least = np.full(len(a.area), np.nan)
    for geometry, i, j in _cross(a.first, b.first):
        s, t = tuple(c[i] for c in a.ends), tuple(c[j] for c in b.ends)
        d2 = np.fmin.reduce([
            _point_segment_d2(s[0], s[1], t), _point_segment_d2(s[2], s[3], t),
            _point_segment_d2(t[0], t[1], s), _point_segment_d2(t[2], t[3], s),
        ])
        d2[_meet(s, t)] = 0.0
        new = np.flatnonzero(np.append(True, np.diff(geometry) != 0))
        at = geometry[new]
        least[at] = np.fmin(least[at], np.fmin.reduceat(d2, new))
    least[_holds(a, b) | _holds(b, a)] = 0.0
    return least


def on_both(a: pa.Array, b: pa.Array, areas: tuple[str, ...], body, kind: pa.DataType) -> pa.Array:
    """``body`` of the edges of two columns of geometries; NULL where one is missing or has a part without points."""
    there = [g.is_valid().to_numpy(zero_copy_only=False) & g.field("parts").is_valid().to_numpy(zero_copy_only=False) for g in (a, b)]
    rows = np.flatnonzero(there[0] & there[1])
    sides = [edges_of(g.take(pa.array(rows)), areas) for g in (a, b)]
    values = np.zeros(len(a), kind.to_pandas_dtype())
    missing = np.ones(len(a), bool)
    values[rows] = found = body(*sides)
    missing[rows] = np.isnan(found) if found.dtype.kind == "f" else False
    return pa.array(values, kind, mask=missing)
