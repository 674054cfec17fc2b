"""Geometries of a whole batch as columns: heads, rings and coordinates, in and out of WKB.

A batch is read in rounds: each round reads one head or one ring of every row that still
has some, so the number of steps is that of the parts of the largest geometry and not of
rows. Heads and rings stand in the order of the bytes; coordinates are one array of points.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tallyhall.functions.wkb import COLLECTION, LINE, POINT, POLYGON, ragged

MAX_NESTING = 16  # of collections in each other; deeper ones are malformed
_SINGLE = POLYGON  # kinds up to here hold points, above geometries


class Shapes:
    """``rows`` geometries.

    ``head_row, kind, count, head_at`` of each head and ``ring_row, ring_head, ring_at, length``
    of each run of points (``*_at`` is the place in the order of a row's parts); ``xy`` holds
    the runs one after the other. ``bad`` marks rows that can't be read, ``null`` null ones;
    neither has heads.
    """

    def __init__(self, rows: int, null: np.ndarray, bad: np.ndarray, heads: np.ndarray, rings: np.ndarray, xy: np.ndarray):
        self.rows, self.null, self.bad, self.xy = rows, null, bad, xy
        self.head_row, self.kind, self.count, self.head_at = heads
        self.ring_row, self.ring_head, self.ring_at, self.length = rings
        self.start = np.cumsum(self.length) - self.length

    # Reading ------------------------------------------------------------------

    @classmethod
    def from_wkb(cls, values: pa.Array) -> Shapes:
        values = values.cast(pa.large_binary())
        n = len(values)
        null = values.is_null().to_numpy(zero_copy_only=False)
        place = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1]
        raw = values.buffers()[2]
        data = np.concatenate([np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8), np.zeros(24, np.uint8)])
        bytes_ = np.lib.stride_tricks.sliding_window_view(data, 16)
        row = np.flatnonzero(~null)
        pos, end = place[:-1][row].copy(), place[1:][row]
        bad = np.zeros(n, bool)
        rest = np.zeros((len(row), MAX_NESTING), np.int64)  # parts to come, by depth
        kinds = np.zeros((len(row), MAX_NESTING), np.int64)  # kind of what holds them
        holder = np.zeros(len(row), np.int64)  # head of the polygon whose rings come
        big = np.zeros(len(row), bool)
        dims = np.full(len(row), 2)
        depth = np.full(len(row), -1)
        heads: list[np.ndarray] = []
        rings: list[np.ndarray] = []  # row, head, at, length, place, dims, big
        made = turn = 0

        def number(at: np.ndarray, big_: np.ndarray) -> np.ndarray:
            four = np.ascontiguousarray(bytes_[np.minimum(at, len(data) - 16), :4])
            return np.where(big_, four.view(">u4")[:, 0], four.view("<u4")[:, 0]).astype(np.int64)

        live = np.arange(len(row))
        while len(live):
            in_rings = (depth[live] >= 0) & (kinds[live, np.maximum(depth[live], 0)] == POLYGON)
            fine = np.ones(len(live), bool)
            done = np.zeros(len(live), bool)  # a run of points ends here
            # heads
            h = np.flatnonzero(~in_rings)
            if len(h):
                g = live[h]
                ok = pos[g] + 5 <= end[g]
                order = data[np.minimum(pos[g], len(data) - 1)]
                big[g] = order == 0
                code = number(pos[g] + 1, big[g])
                pos[g] += 5 + 4 * ((code & 0x20000000) != 0)
                plain = code & 0x0FFFFFFF
                kind, extra = plain % 1000, plain // 1000
                dims[g] = 2 + np.isin(extra, (1, 2, 3)) + (extra == 3) + ((code & 0x80000000) != 0) + ((code & 0x40000000) != 0)
                ok &= (kind >= POINT) & (kind <= COLLECTION)
                counted = kind != POINT
                ok &= ~counted | (pos[g] + 4 <= end[g])
                count = np.where(counted, number(pos[g], big[g]), 1)
                pos[g] += 4 * counted
                room = np.where(kind == LINE, 8 * dims[g], np.where(kind == POINT, 8 * dims[g], np.where(kind == POLYGON, 4, 5)))
                ok &= count * room <= end[g] - pos[g]
                nested = kind > LINE
                ok &= ~nested | (depth[g] + 1 < MAX_NESTING)
                fine[h] = ok
                h, g, kind, count = h[ok], g[ok], kind[ok], count[ok]
                heads.append(np.stack([row[g], kind, count, np.full(len(g), 2 * turn)]))
                own = made + np.arange(len(g))
                made += len(g)
                points = kind <= LINE
                p = g[points]
                rings.append(np.stack([row[p], own[points], np.full(len(p), 2 * turn + 1), count[points], pos[p], dims[p], big[p]]))
                pos[p] += 8 * dims[p] * count[points]
                done[h[points]] = True
                c = g[~points]
                depth[c] += 1
                rest[c, depth[c]] = count[~points]
                kinds[c, depth[c]] = kind[~points]
                holder[c] = own[~points]
            r = np.flatnonzero(in_rings & (rest[live, np.maximum(depth[live], 0)] > 0))
            if len(r):
                g = live[r]
                ok = pos[g] + 4 <= end[g]
                count = number(pos[g], big[g])
                pos[g] += 4
                ok &= count * 8 * dims[g] <= end[g] - pos[g]
                fine[r] = ok
                g, count = g[ok], count[ok]
                rings.append(np.stack([row[g], holder[g], np.full(len(g), 2 * turn + 1), count, pos[g], dims[g], big[g]]))
                pos[g] += 8 * dims[g] * count
                done[r[ok]] = True
            part = live[done & fine]
            inner = part[depth[part] >= 0]
            rest[inner, depth[inner]] -= 1
            bad[row[live[~fine]]] = True
            live = live[fine]
            live = live[~((depth[live] < 0) & np.isin(live, part))]
            while True:  # what is complete counts as a part of what holds it
                full = live[(depth[live] >= 0) & (rest[live, np.maximum(depth[live], 0)] == 0)]
                if not len(full):
                    break
                depth[full] -= 1
                over = full[depth[full] < 0]
                live = live[~np.isin(live, over)]
                inner = full[depth[full] >= 0]
                rest[inner, depth[inner]] -= 1
            turn += 1
        head = np.concatenate([np.empty((4, 0), np.int64), *heads], axis=1)
        ring = np.concatenate([np.empty((7, 0), np.int64), *rings], axis=1).astype(np.int64)
        return cls._ordered(n, null, bad, head, ring, lambda r: _points(bytes_, r))

    @classmethod
    def _ordered(cls, n, null, bad, head, ring, points: Callable) -> Shapes:
        """Heads and rings in order of rows, without those of bad rows."""
        keep = ~bad[head[0]]
        order = np.flatnonzero(keep)[np.lexsort((head[3][keep], head[0][keep]))]
        now = np.full(head.shape[1], -1)
        now[order] = np.arange(len(order))
        keep = ~bad[ring[0]]
        at = np.flatnonzero(keep)[np.lexsort((ring[2][keep], ring[0][keep]))]
        ring = ring[:, at]
        ring[1] = now[ring[1]]
        return cls(n, null, bad, head[:, order], ring[:4], points(ring))

    @classmethod
    def from_geojson(cls, kinds: pa.Array, point: pa.Array, line: pa.Array, rings: pa.Array, polygons: pa.Array, null: np.ndarray) -> Shapes:
        """From type names and the coordinates nested once (points) to four times (multipolygons).

        Of each row the column of its type counts; null there is a row that can't be read.
        """
        names = np.array(kinds.fill_null("").to_pylist(), object)
        n = len(names)
        bad = ~null
        heads, rings_, points, made, placed = [], [], [], 0, 0
        # name, code, column, levels of lists below the parts that are geometries, kind of a part
        for name, code, column, part in (
            ("Point", POINT, point, None),
            ("LineString", LINE, line, None),
            ("Polygon", POLYGON, rings, None),
            ("MultiPoint", 4, line, POINT),
            ("MultiLineString", 5, rings, LINE),
            ("MultiPolygon", 6, polygons, POLYGON),
        ):
            row = np.flatnonzero((names == name) & ~null & column.is_valid().to_numpy(zero_copy_only=False))
            if not len(row):
                continue
            values = column.take(pa.array(row))
            owner = np.arange(len(row))  # which of ``row`` each part is of
            wrong = np.zeros(len(row), bool)

            def below(values: pa.Array, owner: np.ndarray):
                size = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                wrong[owner[values.is_null().to_numpy(zero_copy_only=False)]] = True
                return values.flatten(), np.repeat(np.arange(len(size)), size), size

            head_row = [row]
            head_kind, head_count, head_at = [np.full(len(row), code)], [np.ones(len(row), np.int64)], [np.zeros(len(row), np.int64)]
            holder = np.arange(len(row))  # head of each item
            at = np.zeros(len(row), np.int64)
            if part is not None:  # one head for each part
                values, up, size = below(values, owner)
                head_count[0] = size
                owner, holder = owner[up], len(row) + np.arange(len(up))
                at = 2 + 2 * (np.arange(len(up)) - (np.cumsum(size) - size)[up]) * (1 << 20)
                head_row.append(row[owner])
                head_kind.append(np.full(len(up), part))
                head_count.append(np.ones(len(up), np.int64))
                head_at.append(at)
            inner = part or code
            if inner == POLYGON:
                values, up, size = below(values, owner)
                head_count[-1] = size
                at = at[up] + 1 + 2 * (np.arange(len(up)) - (np.cumsum(size) - size)[up])
                owner, holder = owner[up], holder[up]
            else:
                at = at + 1
            if inner != POINT:
                values, up, length = below(values, owner)
                if inner == LINE:
                    head_count[-1] = length
                point_owner = owner[up]
            else:
                length, point_owner = np.ones(len(owner), np.int64), owner
            flat, up, size = below(values, point_owner)
            wrong[point_owner[size < 2]] = True
            first = np.cumsum(size) - size
            number = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.empty(0)
            missing = flat.is_null().to_numpy(zero_copy_only=False) if len(flat) else np.empty(0, bool)
            wrong[point_owner[up[missing]]] = True
            two = np.minimum(first[:, None] + np.arange(2), max(0, len(number) - 1)) if len(number) else np.zeros((len(first), 2), int)
            points.append(number[two] if len(number) else np.zeros((len(first), 2)))
            bad[row[~wrong]] = False
            heads.append(np.stack([np.concatenate(x) for x in (head_row, head_kind, head_count, head_at)]))
            starts = placed + np.cumsum(length) - length
            rings_.append(np.stack([row[owner], made + holder, at, length, starts]))
            made, placed = made + heads[-1].shape[1], placed + len(first)
        head = np.concatenate([np.empty((4, 0), np.int64), *heads], axis=1).astype(np.int64)
        ring = np.concatenate([np.empty((5, 0), np.int64), *rings_], axis=1).astype(np.int64)
        xy = np.concatenate([np.empty((0, 2)), *points])

        def taken(r: np.ndarray) -> np.ndarray:
            return xy[ragged(r[4], r[3])[1]]

        return cls._ordered(n, null, bad, head, ring, taken)

    # What is in them ----------------------------------------------------------

    @property
    def in_polygon(self) -> np.ndarray:
        return self.kind[self.ring_head] == POLYGON

    @property
    def hole(self) -> np.ndarray:
        """Whether a ring is not the first of its polygon."""
        first = np.ones(len(self.ring_head), bool)
        first[1:] = self.ring_head[1:] != self.ring_head[:-1]
        return self.in_polygon & ~first

    def signed_areas(self) -> np.ndarray:
        """Area of each run of points, positive counter-clockwise, measured from its first point."""
        ring, at = ragged(self.start, np.maximum(self.length - 1, 0))
        if not len(at):
            return np.zeros(len(self.length))
        origin = self.xy[self.start[ring]]
        a, b = self.xy[at] - origin, self.xy[at + 1] - origin
        return np.bincount(ring, a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1], minlength=len(self.length)) / 2

    def ill_formed(self) -> np.ndarray:
        """Rows with a ring that is open, flat, too short or not finite."""
        ring = np.flatnonzero(self.in_polygon)
        finite = np.ones(len(self.length), bool)
        run, at = ragged(self.start, self.length)
        finite[run[~np.isfinite(self.xy[at]).all(axis=1)]] = False
        wrong = (self.length[ring] < 4) | ~finite[ring]
        long_ = ring[~wrong]
        first, last = self.xy[self.start[long_]], self.xy[self.start[long_] + self.length[long_] - 1]
        flat = self.signed_areas()[long_] == 0
        out = np.zeros(self.rows, bool)
        out[self.ring_row[ring[wrong]]] = True
        out[self.ring_row[long_[(first != last).any(axis=1) | flat]]] = True
        return out

    def map(self, change: Callable[[np.ndarray], np.ndarray]) -> Shapes:
        """The same geometries with all points moved."""
        if len(self.xy):
            self.xy = change(self.xy)
        return self

    def orient(self) -> Shapes:
        """Exterior rings counter-clockwise, holes clockwise."""
        turn = self.in_polygon & (self.length > 0) & ((self.signed_areas() < 0) != self.hole)
        ring, at = ragged(self.start, self.length)
        back = turn[ring]
        end = (2 * self.start + self.length - 1)[ring]
        self.xy = self.xy[np.where(back, end - at, at)]
        return self

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Edges x1 y1 x2 y2 of all polygons, oriented, and the row of each; none of length zero."""
        ring, at = ragged(self.start, np.where(self.in_polygon, np.maximum(self.length - 1, 0), 0))
        e = np.hstack([self.xy[at], self.xy[at + 1]]) if len(at) else np.empty((0, 4))
        turn = ((self.signed_areas() < 0) != self.hole)[ring]
        e[turn] = e[turn][:, [2, 3, 0, 1]]
        real = (e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3])
        return e[real], self.ring_row[ring[real]]

    # Writing ------------------------------------------------------------------

    def to_wkb(self, drop: np.ndarray | None = None) -> pa.Array:
        """Little-endian WKB with two coordinates a point; null for bad, null and dropped rows."""
        gone = self.null | self.bad | (False if drop is None else drop)
        kept = ~gone[self.head_row], ~gone[self.ring_row]
        head_size = np.where(self.kind == POINT, 5, 9)[kept[0]]
        in_polygon = self.in_polygon[kept[1]]
        ring_size = 16 * self.length[kept[1]] + 4 * in_polygon
        sizes = np.concatenate([head_size, ring_size])
        row = np.concatenate([self.head_row[kept[0]], self.ring_row[kept[1]]])
        order = np.lexsort((np.concatenate([self.head_at[kept[0]], self.ring_at[kept[1]]]), row))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(sizes[order]) - sizes[order]
        out = np.zeros(int(sizes.sum()) + 16, np.uint8)
        to_head, to_ring = place[: len(head_size)], place[len(head_size) :]
        out[to_head] = 1
        out[to_head + 1] = self.kind[kept[0]]
        counted = head_size == 9
        _put(out, to_head[counted] + 5, self.count[kept[0]][counted], "<u4")
        _put(out, to_ring[in_polygon], self.length[kept[1]][in_polygon], "<u4")
        run, at = ragged(self.start[kept[1]], self.length[kept[1]])
        nth = at - self.start[kept[1]][run]
        window = np.lib.stride_tricks.sliding_window_view(out, 16, writeable=True)
        window[(to_ring + 4 * in_polygon)[run] + 16 * nth] = np.ascontiguousarray(self.xy[at], "<f8").view(np.uint8).reshape(-1, 16)
        ends = np.bincount(row, sizes, minlength=self.rows).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)
        mask = pa.py_buffer(np.packbits(~gone, bitorder="little").tobytes())
        packed = pa.Array.from_buffers(pa.large_binary(), self.rows, [mask, pa.py_buffer(offsets), pa.py_buffer(out)])
        return packed.cast(pa.binary())


def _put(out: np.ndarray, place: np.ndarray, values: np.ndarray, kind: str) -> None:
    if len(place):
        window = np.lib.stride_tricks.sliding_window_view(out, 4, writeable=True)
        window[place] = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, 4)


def _points(bytes_: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Points of rings that lie in the bytes at ``place`` with ``dims`` numbers each."""
    length, place, dims, big = ring[3], ring[4], ring[5], ring[6].astype(bool)
    run, nth = ragged(np.zeros(len(length), np.int64), length)
    raw = np.ascontiguousarray(bytes_[place[run] + 8 * dims[run] * nth])
    xy = raw.view("<f8").astype(np.float64)
    other = big[run]
    if other.any():
        xy[other] = raw[other].view(">f8")
    return xy.reshape(-1, 2)
