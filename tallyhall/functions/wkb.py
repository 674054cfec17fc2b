"""Well-known binary in and out, one geometry at a time, for tests and collections; helpers for the kernels.

A geometry is ``(type, parts)``: parts are (n, 2) coordinate arrays for points,
lines and polygon rings, or nested geometries for the multi types and collections.
"""

from __future__ import annotations

import json
import struct

import numpy as np

POINT, LINE, POLYGON, MULTIPOLYGON, COLLECTION = 1, 2, 3, 6, 7
GEOJSON_TYPES = [
    "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon",
    "GeometryCollection",
]


def read(buf: bytes):
    return _read(buf, 0)[0]


def _read(buf: bytes, pos: int):
    end = "<" if buf[pos] else ">"
    (code,) = struct.unpack_from(end + "I", buf, pos + 1)
    pos += 5
    if code & 0x20000000:  # embedded SRID
        pos += 4
    plain = code & 0x0FFFFFFF
    kind = plain % 1000
    dims = 2 + (plain // 1000 in (1, 2, 3)) + (plain // 1000 == 3)
    dims += bool(code & 0x80000000) + bool(code & 0x40000000)

    def coords(n: int, at: int):
        xy = np.frombuffer(buf, end + "f8", n * dims, at).reshape(n, dims)[:, :2]
        return xy.astype("f8"), at + 8 * n * dims

    if kind == POINT:
        xy, pos = coords(1, pos)
        return (kind, [xy]), pos
    if not LINE <= kind <= COLLECTION:
        raise ValueError(f"unknown geometry type {kind}")
    (n,) = struct.unpack_from(end + "I", buf, pos)
    pos += 4
    if kind == LINE:
        xy, pos = coords(n, pos)
        return (kind, [xy]), pos
    parts = []
    for _ in range(n):
        if kind == POLYGON:
            (m,) = struct.unpack_from(end + "I", buf, pos)
            part, pos = coords(m, pos + 4)
        else:
            part, pos = _read(buf, pos)
        parts.append(part)
    return (kind, parts), pos


def write(geom) -> bytes:
    kind, parts = geom
    out = [struct.pack("<BI", 1, kind)]
    if kind == LINE:
        out.append(struct.pack("<I", len(parts[0])))
    elif kind != POINT:
        out.append(struct.pack("<I", len(parts)))
    for part in parts:
        if kind > POLYGON:
            out.append(write(part))
            continue
        if kind == POLYGON:
            out.append(struct.pack("<I", len(part)))
        out.append(np.ascontiguousarray(part, "<f8").tobytes())
    return b"".join(out)


def from_geojson(text: str):
    return _from_geojson(json.loads(text))


def _from_geojson(obj: dict):
    kind = GEOJSON_TYPES.index(obj["type"]) + 1
    if kind == COLLECTION:
        return kind, [_from_geojson(g) for g in obj["geometries"]]
    xy = obj["coordinates"]

    def points(c):
        return np.array([p[:2] for p in c], "f8").reshape(-1, 2)

    if kind == POINT:
        return kind, [points([xy])]
    if kind == LINE:
        return kind, [points(xy)]
    if kind == POLYGON:
        return kind, [points(r) for r in xy]
    return kind, [_from_geojson({"type": GEOJSON_TYPES[kind - 4], "coordinates": c}) for c in xy]


def signed_area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2


def collection(text: str) -> bytes | None:
    """WKB of one GeoJSON geometry of any kind, null if it can't be read."""
    try:
        return write(from_geojson(text))
    except (ValueError, KeyError, IndexError, TypeError, struct.error):
        return None


def ragged(starts: np.ndarray, lengths: np.ndarray):
    """Row number and element index for runs of ``lengths`` elements at ``starts``."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return rows, np.arange(len(rows)) - first[rows] + starts[rows]


def cross(e: np.ndarray) -> np.ndarray:
    """Twice the signed area between each edge and the origin."""
    return e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]


def sides(a: np.ndarray, b: np.ndarray):
    """Which side of segment a each end of b lies on, and the reverse (signs)."""

    def side(s, px, py):
        return np.sign(
            (s[:, 2] - s[:, 0]) * (py - s[:, 1]) - (s[:, 3] - s[:, 1]) * (px - s[:, 0])
        )

    return (
        side(a, b[:, 0], b[:, 1]),
        side(a, b[:, 2], b[:, 3]),
        side(b, a[:, 0], a[:, 1]),
        side(b, a[:, 2], a[:, 3]),
    )


def self_crossing(e: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per geometry of a batch, whether two of its edges cross inside both.

    A sweep along x for the whole batch: geometries lie side by side on one key,
    and each edge is held against those that start before it ends.
    """
    out = np.zeros(rows, bool)
    if not len(e):
        return out
    lo, hi = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    start = np.flatnonzero(np.diff(row, prepend=-1))
    which = np.cumsum(np.diff(row, prepend=-1) != 0) - 1
    west = np.minimum.reduceat(lo, start)[which]
    span = np.maximum.reduceat(hi, start)[which] - west
    span[span == 0] = 1
    key = 2 * which + (lo - west) / span
    order = np.argsort(key, kind="stable")
    e, row, key = e[order], row[order], key[order]
    reach = (2 * which + (hi - west) / span)[order] + 1e-9  # rounding may not hide a pair
    ahead = np.searchsorted(key, reach, "right") - np.arange(len(e)) - 1
    steps = np.cumsum(ahead) // 1_000_000
    for part in np.split(np.arange(len(e)), np.flatnonzero(np.diff(steps)) + 1):
        i, j = ragged(part + 1, ahead[part])
        i = part[i]
        o1, o2, o3, o4 = sides(e[i], e[j])
        out[row[i[(o1 * o2 < 0) & (o3 * o4 < 0)]]] = True
    return out
