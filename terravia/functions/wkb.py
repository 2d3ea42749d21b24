"""WKB decoding: the one format Spark's built-ins cannot read, done per Arrow batch."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from terravia.functions.geom import GEOM_TYPE

# fixed values of the WKB format
KIND_CODES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON"}
FLAG_Z, FLAG_M, FLAG_SRID = 0x80000000, 0x40000000, 0x20000000


class Batch:
    """Geometries of one Arrow batch as flat arrays: per geometry, per part, and coordinates as blocks."""

    def __init__(self):
        self.missing, self.srid, self.kind, self.dim, self.n_parts = [], [], [], [], []
        self.ring, self.n_points, self.blocks = [], [], []

    def add(self, raw: bytes | None, srid: int) -> None:
        self.missing.append(raw is None)
        if raw is None:
            self.srid.append(0)
            self.kind.append("")
            self.dim.append(0)
            self.n_parts.append(0)
            return
        before = len(self.ring)
        _, kind, dim, own = self._geometry(raw, 0)
        self.srid.append(srid if own is None else own)
        self.kind.append(kind)
        self.dim.append(dim)
        self.n_parts.append(len(self.ring) - before)

    def _points(self, raw, pos, order, dim, n, ring) -> int:
        # only where the coordinates lie: they are read as one block, x and y of all points at once
        self.blocks.append(np.frombuffer(raw, order + "f8", n * dim, pos).reshape(n, dim)[:, :2])
        self.ring.append(ring)
        self.n_points.append(n)
        return pos + 8 * n * dim

    def _geometry(self, raw, pos):
        order = "<" if raw[pos] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", raw, pos + 1)
        pos, own = pos + 5, None
        if code & FLAG_SRID:
            (own,) = struct.unpack_from(order + "i", raw, pos)
            pos += 4
        base = code & 0x0FFFFFFF
        iso = base // 1000  # ISO codes add 1000 (Z), 2000 (M) or 3000 (ZM)
        dim = 2 + bool(code & FLAG_Z) + bool(code & FLAG_M) + (0, 1, 1, 2)[min(iso, 3)]
        kind = KIND_CODES.get(base % 1000)
        if kind is None:
            raise ValueError(f"unsupported WKB kind {base}")
        if kind == "POINT":
            return self._points(raw, pos, order, dim, 1, 0), kind, dim, own
        (n,) = struct.unpack_from(order + "I", raw, pos)
        pos += 4
        if kind == "LINESTRING":
            pos = self._points(raw, pos, order, dim, n, 0)
        elif kind == "POLYGON":
            for i in range(n):
                (m,) = struct.unpack_from(order + "I", raw, pos)
                pos = self._points(raw, pos + 4, order, dim, m, min(i, 1))
        else:
            for _ in range(n):
                pos = self._geometry(raw, pos)[0]
        return pos, kind, dim, own

    def array(self) -> pa.Array:
        """The geometry column of the batch."""
        xy = np.concatenate(self.blocks) if self.blocks else np.empty((0, 2))
        point = pa.StructArray.from_arrays([pa.array(xy[:, 0].astype("<f8")), pa.array(xy[:, 1].astype("<f8"))], ["x", "y"])
        ends = np.concatenate(([0], np.cumsum(self.n_points))).astype(np.int32)
        points = pa.ListArray.from_arrays(pa.array(ends), point)
        part = pa.StructArray.from_arrays([pa.array(self.ring, pa.int32()), points], ["ring", "pts"])
        ends = np.concatenate(([0], np.cumsum(self.n_parts))).astype(np.int32)
        columns = [
            pa.array(self.srid, pa.int32()), pa.array(self.kind, pa.string()), pa.array(self.dim, pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends), part),
        ]
        return pa.StructArray.from_arrays(columns, ["srid", "kind", "dim", "parts"], mask=pa.array(self.missing, pa.bool_()))


def from_wkb(column, srid: int = 2154):
    """Geometry column from WKB or EWKB bytes; NULL stays NULL."""

    @F.arrow_udf(GEOM_TYPE)
    def decode_batch(raw: pa.Array) -> pa.Array:
        batch = Batch()
        for b in raw:
            batch.add(b.as_py(), srid)
        return batch.array()

    return decode_batch(column)


def encode(geom: dict) -> bytes:
    """Little-endian 2D WKB of one geometry dict."""
    codes = {kind: code for code, kind in KIND_CODES.items()}

    def points(pts):
        return b"".join(struct.pack("<2d", p["x"], p["y"]) for p in pts)

    def counted(items):
        return struct.pack("<I", len(items))

    def one(kind, parts):
        head = struct.pack("<BI", 1, codes[kind])
        if kind == "POINT":
            return head + points(parts[0]["pts"])
        if kind == "LINESTRING":
            return head + counted(parts[0]["pts"]) + points(parts[0]["pts"])
        if kind == "POLYGON":
            return head + counted(parts) + b"".join(counted(p["pts"]) + points(p["pts"]) for p in parts)
        members = []
        for p in parts:
            if kind == "MULTIPOLYGON" and p["ring"] and members:
                members[-1].append(p)
            else:
                members.append([p])
        single = kind.removeprefix("MULTI")
        return head + counted(members) + b"".join(one(single, m) for m in members)

    return one(geom["kind"], geom["parts"])


def to_wkb(geom):
    """WKB bytes of a geometry column; NULL stays NULL."""

    @F.pandas_udf("binary")
    def encode_batch(geoms: pd.DataFrame) -> pd.Series:
        return pd.Series(
            [None if g.kind is None else encode({"kind": g.kind, "parts": list(g.parts)}) for g in geoms.itertuples()]
        )

    return encode_batch(geom)
