"""Well-known binary and text of points, lines, polygons, their multiples and collections.

A geometry is (kind, coordinates): a point's are a pair, a line's an (n, 2) array, a
polygon's a list of rings, and those of the others a list of the parts' coordinates (a
collection's: of geometries).
"""

from __future__ import annotations

import struct

import numpy as np

POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(1, 8)
NAMES = {POINT: "Point", LINE: "LineString", POLYGON: "Polygon", MULTIPOINT: "MultiPoint", MULTILINE: "MultiLineString", MULTIPOLYGON: "MultiPolygon", COLLECTION: "GeometryCollection"}
PART = {MULTIPOINT: POINT, MULTILINE: LINE, MULTIPOLYGON: POLYGON}


def _count(n: int) -> bytes:
    return struct.pack("<I", n)


def _sequence(points) -> bytes:
    return _count(len(points)) + np.ascontiguousarray(points, "<f8").tobytes()


def dump(kind: int, data) -> bytes:
    head = struct.pack("<BI", 1, kind)
    if kind == POINT:
        return head + np.asarray(data if data is not None else (np.nan, np.nan), "<f8").tobytes()
    if kind == LINE:
        return head + _sequence(data)
    if kind == POLYGON:
        return head + _count(len(data)) + b"".join(_sequence(r) for r in data)
    if kind == COLLECTION:
        return head + _count(len(data)) + b"".join(dump(*g) for g in data)
    return head + _count(len(data)) + b"".join(dump(PART[kind], x) for x in data)


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, fmt: str):
        out = struct.unpack_from(fmt, self.data, self.at)
        self.at += struct.calcsize(fmt)
        return out

    def points(self, order: str, n: int, dims: int) -> np.ndarray:
        out = np.frombuffer(self.data, order + "f8", n * dims, self.at).reshape(n, dims)[:, :2].astype(float)
        self.at += 8 * n * dims
        return out

    def geometry(self):
        order = "<" if self.take("B")[0] else ">"
        (code,) = self.take(order + "I")
        dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
        if code & 0x20000000:  # an SRID follows
            self.take(order + "I")
        code &= 0x0FFFFFFF
        dims, kind = dims + (0, 1, 1, 2)[code // 1000], code % 1000
        if kind == POINT:
            p = self.points(order, 1, dims)[0]
            return POINT, None if np.isnan(p).any() else p
        (n,) = self.take(order + "I")
        if kind == LINE:
            return LINE, self.points(order, n, dims)
        if kind == POLYGON:
            return POLYGON, [self.points(order, self.take(order + "I")[0], dims) for _ in range(n)]
        parts = [self.geometry() for _ in range(n)]
        return kind, parts if kind == COLLECTION else [x for _, x in parts]


def load(data: bytes):
    """(kind, coordinates) of WKB or EWKB, two dimensions kept."""
    return _Reader(bytes(data)).geometry()


def is_empty(kind: int, data) -> bool:
    if kind == COLLECTION:
        return all(is_empty(*g) for g in data)
    if kind in PART:
        return all(is_empty(PART[kind], x) for x in data)
    return data is None or len(data) == 0 or (kind == POLYGON and len(data[0]) == 0)


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(float(x))


def _pairs(points) -> str:
    return "(" + ", ".join(f"{_number(x)} {_number(y)}" for x, y in points) + ")"


def _body(kind: int, data) -> str:
    """The text after the kind's name; multiples and collections of empty parts still list these."""
    if len(data) == 0 if kind == COLLECTION or kind in PART else is_empty(kind, data):
        return "EMPTY"
    if kind == POINT:
        return _pairs([data])
    if kind == LINE:
        return _pairs(data)
    if kind == POLYGON:
        return "(" + ", ".join(map(_pairs, data)) + ")"
    if kind == COLLECTION:
        return "(" + ", ".join(to_text(*g) for g in data) + ")"
    return "(" + ", ".join(_body(PART[kind], x) for x in data) + ")"


def to_text(kind: int, data) -> str:
    return f"{NAMES[kind].upper()} {_body(kind, data)}"


def _listed(kind: int, data):
    if kind == POINT:
        return [] if data is None else [float(v) for v in data]
    if kind == LINE:
        return np.asarray(data, float).reshape(-1, 2).tolist()
    if kind == POLYGON:
        return [np.asarray(r, float).tolist() for r in data]
    return [_listed(PART[kind], x) for x in data]


def to_geojson(kind: int, data) -> dict:
    if kind == COLLECTION:
        return {"type": NAMES[kind], "geometries": [to_geojson(*g) for g in data]}
    return {"type": NAMES[kind], "coordinates": _listed(kind, data)}


def lines_of(kind: int, data) -> list[np.ndarray]:
    """The lines of a line, multi-line or collection of these; others raise."""
    if kind == LINE:
        return [data]
    if kind == MULTILINE:
        return list(data)
    if kind == COLLECTION:
        return [x for g in data for x in lines_of(*g)]
    raise ValueError(f"{NAMES[kind]} has no lines")


def transform(kind: int, data, f):
    """The geometry with f applied to its coordinate arrays."""
    if kind == POINT:
        return kind, None if data is None else f(np.asarray(data).reshape(1, 2))[0]
    if kind == LINE:
        return kind, f(np.asarray(data))
    if kind == POLYGON:
        return kind, [f(np.asarray(r)) for r in data]
    if kind == COLLECTION:
        return kind, [transform(*g, f) for g in data]
    return kind, [transform(PART[kind], x, f)[1] for x in data]
