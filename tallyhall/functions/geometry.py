"""Geometry columns: WKB binary in and out, Arrow batches inside.

Planar mode measures in the units of the coordinates. Geography mode projects
degrees to an equal-area cylinder first and measures square metres.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhall.functions import fixed_values as fv
from tallyhall.functions import wkb
from tallyhall.functions.shapes import Shapes

MODES = ("planar", "geography")
BOX = "minx:double,miny:double,maxx:double,maxy:double"
PARTS = f"struct<edges:array<double>,{BOX},area:double>"
PIECES = f"struct<area:double,edges:array<array<double>>,boxes:array<struct<{BOX}>>>"
PIECE_EDGES = 256  # polygons of more edges are cut into upright strips
MAX_EDGE_PAIRS = 2_000_000  # per numpy step; bounds memory, not the input


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")


def _equal_area(xy: np.ndarray) -> np.ndarray:
    """Degrees to metres on the equal-area cylinder; columns alternate x, y."""
    rad = np.radians(xy)
    out = np.empty_like(rad)
    out[:, ::2] = rad[:, ::2] * fv.EARTH_RADIUS_M
    out[:, 1::2] = np.sin(rad[:, 1::2]) * fv.EARTH_RADIUS_M
    return out


def _areas(e: np.ndarray, row: np.ndarray, n: int, mode: str) -> np.ndarray:
    """Area per row, each measured from a corner of its own."""
    if not len(e):
        return np.zeros(n)
    e = _equal_area(e) if mode == "geography" else e
    first = np.zeros(n, "i8")
    first[row[::-1]] = np.arange(len(row))[::-1]
    return np.bincount(row, wkb.cross(e - e[first[row]][:, [0, 1, 0, 1]]), minlength=n) / 2


def _edges(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Oriented edges of all polygons in a batch of WKB, and the row each belongs to."""
    shapes = Shapes.from_wkb(values)
    if shapes.bad.any():
        raise ValueError(f"cannot read geometry: {values[int(np.flatnonzero(shapes.bad)[0])].as_py()[:40]!r}")
    return shapes.edges()


def geom_type(g: Column) -> Column:
    """Type code 1-7 read from the WKB header, without leaving the JVM."""

    def byte(i: int) -> Column:
        return F.hex(F.substring(g, i, 1))

    little = F.concat(byte(5), byte(4), byte(3), byte(2))
    big = F.concat(byte(2), byte(3), byte(4), byte(5))
    code = F.conv(F.when(byte(1) == "01", little).otherwise(big), 16, 10).cast("long")
    return (code.bitwiseAND(F.lit(0x0FFFFFFF)) % 1000).cast("int")


def _boxes(e: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bounding box of each run of edges, nan for empty runs."""
    out = np.full((len(length), 4), np.nan)
    some = length > 0
    if some.any():
        low = np.minimum.reduceat(e, start[some], axis=0)
        high = np.maximum.reduceat(e, start[some], axis=0)
        out[some, :2] = np.minimum(low[:, :2], low[:, 2:])
        out[some, 2:] = np.maximum(high[:, :2], high[:, 2:])
    return out


def _lists(length: np.ndarray, values: pa.Array, width: int = 1) -> pa.ListArray:
    ends = np.append(0, np.cumsum(length)) * width
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def parts(g: Column, mode: str = "geography") -> Column:
    """Ring edges in source coordinates, bounding box and area, parsed once."""
    _check(mode)

    @F.arrow_udf(PARTS)
    def kernel(values: pa.Array) -> pa.Array:
        n = len(values)
        e, row = _edges(values)
        length = np.bincount(row, minlength=n)
        box = _boxes(e, np.cumsum(length) - length, length)
        edges = _lists(length, pa.array(e.ravel()), 4)
        columns = [edges, *[pa.array(c) for c in box.T], pa.array(_areas(e, row, n, mode))]
        names = ["edges", "minx", "miny", "maxx", "maxy", "area"]
        return pa.StructArray.from_arrays(columns, names, mask=pa.array(length == 0))

    return kernel(g)


def _cuts(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Strip borders that leave about PIECE_EDGES edges to a strip.

    An edge belongs to every strip it reaches. Fewer strips are made where long
    edges would be repeated more than four times on average.
    """
    count = -(-len(low) // PIECE_EDGES)
    middle = (low + high) / 2
    while True:
        inner = np.unique(np.quantile(middle, np.arange(1, count) / count))
        borders = np.concatenate([[low.min()], inner, [high.max()]])
        held = np.searchsorted(np.sort(low), borders[1:], "right") - np.searchsorted(
            np.sort(high), borders[:-1], "left"
        )
        if count == 1 or held.sum() <= 4 * len(low):
            return borders
        count //= 2


def pieces(g: Column, mode: str = "geography") -> Column:
    """Area, and the polygon as upright strips: the edges and the box of each.

    A polygon of many edges is cut so that whoever meets it needs only the edges
    nearby. Edges keep their full length; a strip is the x range of its box, and
    overlap areas of strips add up to that of the polygon. Null without polygons.
    """
    _check(mode)

    @F.arrow_udf(PIECES)
    def kernel(values: pa.Array) -> pa.Array:
        n = len(values)
        e, row = _edges(values)
        length = np.bincount(row, minlength=n)
        start = np.cumsum(length) - length
        small = np.flatnonzero((length > 0) & (length <= PIECE_EDGES))
        _, index = wkb.ragged(start[small], length[small])
        owner, held = [small], [length[small]]
        indexes, spans = [index], [_boxes(e, start, length)[small][:, [0, 2]]]
        for big in np.flatnonzero(length > PIECE_EDGES):
            own = np.arange(start[big], start[big] + length[big])
            low, high = np.minimum(e[own, 0], e[own, 2]), np.maximum(e[own, 0], e[own, 2])
            borders = _cuts(low, high)
            for x1, x2 in zip(borders, borders[1:], strict=False):
                inside = own[(high >= x1) & (low <= x2)]
                owner.append([big])
                held.append([len(inside)])
                indexes.append(inside)
                spans.append([[x1, x2]])
        owner, held = np.concatenate(owner).astype("i8"), np.concatenate(held).astype("i8")
        order = np.argsort(owner, kind="stable")
        _, at = wkb.ragged((np.cumsum(held) - held)[order], held[order])
        flat, held = e[np.concatenate(indexes).astype("i8")[at]], held[order]
        box = _boxes(flat, np.cumsum(held) - held, held)
        box[:, [0, 2]] = np.concatenate(spans)[order]
        each = np.bincount(owner, minlength=n)
        names = ["minx", "miny", "maxx", "maxy"]
        boxes = pa.StructArray.from_arrays([pa.array(c) for c in box.T], names)
        columns = [
            pa.array(_areas(e, row, n, mode)),
            _lists(each, _lists(held, pa.array(flat.ravel()), 4)),
            _lists(each, boxes),
        ]
        return pa.StructArray.from_arrays(
            columns, ["area", "edges", "boxes"], mask=pa.array(each == 0)
        )

    return kernel(g)


def st_area(g: Column, mode: str = "geography") -> Column:
    """Area; zero for points and lines, null for null."""
    _check(mode)

    @F.arrow_udf("double")
    def kernel(values: pa.Array) -> pa.Array:
        e, row = _edges(values)
        return pa.array(
            _areas(e, row, len(values), mode),
            mask=values.is_null().to_numpy(zero_copy_only=False),
        )

    return kernel(g)


def _near(lists: pa.Array, lo: np.ndarray, hi: np.ndarray):
    """Flat (n, 4) edges of a list column that reach [lo, hi], and the row of each."""
    length = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype("i8") // 4
    e = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
    row = np.repeat(np.arange(len(length)), length)
    x, x2 = e[:, 0].copy(), e[:, 2].copy()
    near = np.maximum(x, x2) >= np.repeat(lo, length)
    near &= np.minimum(x, x2) <= np.repeat(hi, length)
    at = np.flatnonzero(near)
    return e.take(at, axis=0), row.take(at)


def _edge_pairs(a_len: np.ndarray, b_len: np.ndarray):
    """(row, left edge, right edge) for every pair within a row, in bounded steps."""
    a_start = np.cumsum(a_len) - a_len
    row = np.repeat(np.arange(len(b_len)), b_len)
    steps = np.cumsum(a_len[row]) // MAX_EDGE_PAIRS
    for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(steps)) + 1):
        if len(part):
            at, a_index = wkb.ragged(a_start[row[part]], a_len[row[part]])
            yield row[part][at], a_index, part[at]


def overlap_areas(
    left: pa.Array, right: pa.Array, lo: np.ndarray, hi: np.ndarray, smaller: np.ndarray, mode: str
) -> np.ndarray:
    """Area each row's two polygons share between x = lo and x = hi, nan without contact.

    For rings oriented alike, the area of the intersection is minus half the sum,
    over all pairs of edges, of (direction of a) * (direction of b) * the integral
    of |a(x) - b(x)| over the x range both edges span. Holes and concave rings
    need no special care, and there is nothing to clip. Areas below 1e-9 of
    ``smaller`` are rounding: the row then counts as touching if edges meet.
    """
    n = len(left)
    a, a_row = _near(left, lo, hi)
    b, b_row = _near(right, lo, hi)
    a_len, b_len = np.bincount(a_row, minlength=n), np.bincount(b_row, minlength=n)
    project = _equal_area if mode == "geography" else lambda xy: xy
    first = a[np.minimum(np.cumsum(a_len) - a_len, max(len(a) - 1, 0)), 1] if len(a) else np.zeros(n)
    origin = project(np.column_stack([lo, first, hi, first]))
    span = origin[:, 2] - origin[:, 0]

    def sloped(edges, row):
        """Columns of the edges that span an x range, seen from near: that keeps the digits."""
        some = np.flatnonzero(edges[:, 0] != edges[:, 2])
        row = row.take(some)
        away = [origin[:, c].take(row) for c in (0, 1)]
        x, y, x2, y2 = (end - away[c % 2] for c, end in enumerate(project(edges.take(some, axis=0)).T))
        return (x, y, y2 - y, x2 - x), np.minimum(x, x2), np.maximum(x, x2), np.sign(x2 - x), row

    def at(line, which, x):
        x0, y0, rise, run = (c.take(which) for c in line)
        return [y0 + (end - x0) * rise / run for end in x]

    area = np.zeros(n)
    (e, e_low, e_high, e_sign, e_row), (f, f_low, f_high, f_sign, f_row) = sloped(a, a_row), sloped(b, b_row)
    for row, i, j in _edge_pairs(np.bincount(e_row, minlength=n), np.bincount(f_row, minlength=n)):
        x1 = np.maximum(np.maximum(e_low.take(i), f_low.take(j)), 0)
        x2 = np.minimum(np.minimum(e_high.take(i), f_high.take(j)), span.take(row))
        ok = np.flatnonzero(x2 > x1)
        row, i, j, x1, x2 = (c.take(ok) for c in (row, i, j, x1, x2))
        d1, d2 = (p - q for p, q in zip(at(e, i, (x1, x2)), at(f, j, (x1, x2)), strict=True))
        size = np.abs(d1) + np.abs(d2)
        mean = size / 2
        turn = np.flatnonzero(d1 * d2 < 0)
        mean[turn] = (d1[turn] * d1[turn] + d2[turn] * d2[turn]) / (2 * size[turn])
        area -= np.bincount(row, e_sign[i] * f_sign[j] * mean * (x2 - x1), minlength=n) / 2
    solid = area > 1e-9 * smaller
    out = np.where(solid, np.minimum(area, smaller), np.nan)

    # The rest meet, if at all, along their boundaries only.
    a, b = a[~solid[a_row]], b[~solid[b_row]]
    for row, i, j in _edge_pairs(np.where(solid, 0, a_len), np.where(solid, 0, b_len)):
        e, f = a[i], b[j]
        o1, o2, o3, o4 = wkb.sides(e, f)
        meet = (o1 * o2 <= 0) & (o3 * o4 <= 0)
        for x in (0, 1):
            meet &= np.maximum(e[:, x], e[:, x + 2]) >= np.minimum(f[:, x], f[:, x + 2])
            meet &= np.minimum(e[:, x], e[:, x + 2]) <= np.maximum(f[:, x], f[:, x + 2])
        out[row[meet]] = 0.0
    return out


def box_pairs(a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray):
    """Rows of a and b that share a group, whose boxes meet, and that start there, in bounded steps.

    Rows are sorted by group; ``a_len`` and ``b_len`` count them. A row is its box and, for
    each axis, whether its low end lies in the group's cell: of the cells a pair shares, it is
    given in the one with the lower-left corner of the common box.
    """
    a_start, b_start = np.cumsum(a_len) - a_len, np.cumsum(b_len) - b_len

    def meet(x, y):
        found = (x[0] <= y[2]) & (x[2] >= y[0])
        found &= (x[1] <= y[3]) & (x[3] >= y[1])
        return found & ((x[4] > 0) | (y[4] > 0)) & ((x[5] > 0) | (y[5] > 0))

    large = a_len * b_len > MAX_EDGE_PAIRS // 512
    group = np.repeat(np.arange(len(a_len)), np.where(large, 0, a_len))
    own, at = wkb.ragged(a_start, np.where(large, 0, a_len))
    steps = np.cumsum(b_len[own]) // (MAX_EDGE_PAIRS // 8)
    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(steps)) + 1):
        row, j = wkb.ragged(b_start[group[part]], b_len[group[part]])
        i = at[part][row]
        found = meet(a[i].T, b[j].T)
        yield i[found], j[found]
    for g in np.flatnonzero(large):
        y = b[b_start[g] : b_start[g] + b_len[g]].T[:, None, :]
        step = max(1, MAX_EDGE_PAIRS // 8 // b_len[g])
        for i in range(a_start[g], a_start[g] + a_len[g], step):
            x = a[i : min(i + step, a_start[g] + a_len[g])].T[:, :, None]
            row, j = np.divmod(np.flatnonzero(meet(x, y)), b_len[g])
            yield row + i, j + b_start[g]


def edges_overlap(
    left: Column, right: Column, lo: Column, hi: Column, smaller: Column, mode: str = "geography"
) -> Column:
    """Area two edge lists share for x in [lo, hi]: zero when they only touch there,
    null when apart. ``smaller`` is the area of the smaller polygon.

    Declared nondeterministic so that a filter on the result is not pushed below
    it, which would run the kernel once to filter and once more to report.
    """
    _check(mode)

    @F.arrow_udf("double")
    def kernel(a: pa.Array, b: pa.Array, x1: pa.Array, x2: pa.Array, s: pa.Array) -> pa.Array:
        lo, hi, small = (c.to_numpy(zero_copy_only=False) for c in (x1, x2, s))
        area = overlap_areas(a, b, lo, hi, small, mode)
        return pa.array(area, pa.float64(), mask=np.isnan(area))

    return kernel.asNondeterministic()(left, right, lo, hi, smaller)


def _overlap(a: Column, b: Column, mode: str) -> Column:
    p, q = parts(a, mode), parts(b, mode)
    lo, hi = F.greatest(p["minx"], q["minx"]), F.least(p["maxx"], q["maxx"])
    return edges_overlap(p["edges"], q["edges"], lo, hi, F.least(p["area"], q["area"]), mode)


def st_intersection_area(a: Column, b: Column, mode: str = "geography") -> Column:
    """Area of the intersection; zero when apart, null when either is null."""
    area = F.coalesce(_overlap(a, b, mode), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), area)


def st_intersects(a: Column, b: Column) -> Column:
    """Whether two polygons share a point; touching counts. Null when either is null."""
    meets = _overlap(a, b, "planar").isNotNull()
    return F.when(a.isNotNull() & b.isNotNull(), meets)


def _rewrite(g: Column, change: Callable[[Shapes], Shapes]) -> Column:
    @F.arrow_udf("binary")
    def kernel(values: pa.Array) -> pa.Array:
        shapes = Shapes.from_wkb(values)
        if shapes.bad.any():
            raise ValueError("cannot read geometry")
        return change(shapes).to_wkb()

    return kernel(g)


def orient(g: Column) -> Column:
    """Exterior rings counter-clockwise, holes clockwise."""
    return _rewrite(g, lambda shapes: shapes.orient())


def _projection(src: int, dst: int) -> Callable[[np.ndarray], np.ndarray] | None:
    """Points from one system to another; None where they stay."""
    if {src, dst} <= {4326, 4269} or src == dst:
        return None
    r = fv.MERCATOR_RADIUS_M
    if src in (4326, 4269) and dst == 3857:

        def change(xy):
            lon, lat = np.radians(xy).T
            return np.column_stack([r * lon, r * np.arctanh(np.sin(lat))])

    elif src == 3857 and dst in (4326, 4269):

        def change(xy):
            return np.degrees(np.column_stack([xy[:, 0] / r, np.arctan(np.sinh(xy[:, 1] / r))]))

    else:
        raise ValueError(f"no transformation from {src} to {dst}")
    return change


def reproject(g: Column, src: int, dst: int) -> Column:
    """Between degrees (4326; 4269 differs by under a metre) and Mercator metres (3857)."""
    change = _projection(src, dst)
    return g if change is None else _rewrite(g, lambda shapes: shapes.map(change))


def to_wkb(g: Column, strict: bool = True, geojson: bool = False, source: int = 4326) -> Column:
    """Oriented WKB in degrees from WKB or GeoJSON text in the system ``source``.

    Unusable shapes raise, or are null if not strict. Reading, moving, checking, turning
    and writing are one kernel over the columns of a batch.
    """
    change = _projection(source, 4326)

    def finish(shapes: Shapes) -> pa.Array:
        if change is not None:
            shapes = shapes.map(change)
        wrong = shapes.ill_formed()
        if strict and (wrong | shapes.bad).any():
            said = "a ring is open, flat or too short" if wrong.any() else "it is malformed"
            raise ValueError(f"cannot read geometry: {said}")
        shapes = shapes.orient()
        e, row = shapes.edges()
        crossing = wkb.self_crossing(e, row, shapes.rows)
        if strict and crossing.any():
            raise ValueError("cannot read geometry: edges cross")
        return shapes.to_wkb(drop=wrong | crossing)

    if not geojson:

        @F.arrow_udf("binary")
        def from_bytes(values: pa.Array) -> pa.Array:
            return finish(Shapes.from_wkb(values))

        return from_bytes(g)

    @F.arrow_udf("binary")
    def from_text(text: pa.Array, kinds: pa.Array, point: pa.Array, line: pa.Array, rings: pa.Array, polygons: pa.Array) -> pa.Array:
        null = text.is_null().to_numpy(zero_copy_only=False)
        collection = np.array(kinds.fill_null("").to_pylist(), object) == "GeometryCollection"
        made = finish(Shapes.from_geojson(kinds, point, line, rings, polygons, null | collection))
        if not collection.any():
            return made
        # Collections nest freely: they become WKB one by one, the rest is as above.
        picked = [wkb.collection(v) if use else None for v, use in zip(text.to_pylist(), collection)]
        if strict and any(p is None for p, use in zip(picked, collection) if use):
            raise ValueError("cannot read geometry: a collection is malformed")
        return pa.compute.if_else(pa.array(collection), finish(Shapes.from_wkb(pa.array(picked, pa.binary()))), made)

    parsed = F.from_json(g, "type string, coordinates string")
    nested = ["array<double>", "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"]
    named = [["Point"], ["LineString", "MultiPoint"], ["Polygon", "MultiLineString"], ["MultiPolygon"]]
    columns = [
        F.when(parsed["type"].isin(names), F.from_json(parsed["coordinates"], kind)) for names, kind in zip(named, nested)
    ]
    return from_text(g, parsed["type"], *columns)


def tile_runs(g: Column, zoom: int) -> Column:
    """Bounds of the polygon, and the runs of Web-Mercator tiles that it meets, row by row.

    Tiles count with their borders. An edge is looked at in the rows of tiles it spans only:
    there its part between the row's latitudes gives the tiles on the polygon's border. Tiles
    in the inside are the runs between the crossings of the row's middle. What leaves the
    kernel is a run for each stretch of tiles, not edges: as many as the border is long.
    """
    n = 1 << zoom

    @F.arrow_udf(f"struct<{BOX},runs:array<struct<y:int,x0:int,x1:int>>>")
    def kernel(values: pa.Array) -> pa.Array:
        rows = len(values)
        e, poly = _edges(values)
        length = np.bincount(poly, minlength=rows)
        box = _boxes(e, np.cumsum(length) - length, length)
        found = [np.empty((4, 0), np.int64)]
        for part in np.array_split(np.arange(len(e)), max(1, len(e) * 4 // MAX_EDGE_PAIRS)):
            found.append(_border_tiles(e[part], poly[part], n))
        found.append(_inner_tiles(e, poly, n))
        owner, y, x0, x1 = _merged(np.concatenate(found, axis=1), n)
        runs = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in (y, x0, x1)], ["y", "x0", "x1"])
        columns = [*[pa.array(c) for c in box.T], _lists(np.bincount(owner, minlength=rows), runs)]
        names = ["minx", "miny", "maxx", "maxy", "runs"]
        return pa.StructArray.from_arrays(columns, names, mask=pa.array(length == 0))

    return kernel(g)


def _latitude(row: np.ndarray, n: int) -> np.ndarray:
    """Northern border of a row of tiles."""
    return np.degrees(np.arctan(np.sinh(np.pi * (1 - 2 * row / n))))


def _row_of(lat: np.ndarray, n: int) -> np.ndarray:
    s = np.sin(np.radians(np.clip(lat, -fv.MERCATOR_LAT_LIMIT, fv.MERCATOR_LAT_LIMIT)))
    return np.floor((0.5 - 0.25 * np.log((1 + s) / (1 - s)) / np.pi) * n).astype(np.int64)


def _columns(low: np.ndarray, high: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last tile that meets [low, high], borders included."""

    def west(x):
        return x / n * 360.0 - 180.0

    first = np.floor((low + 180.0) / 360.0 * n).astype(np.int64)
    last = np.floor((high + 180.0) / 360.0 * n).astype(np.int64)
    first -= west(first) >= low
    last += west(last + 1) <= high
    return np.maximum(first, 0), np.minimum(last, n - 1)


def _border_tiles(e: np.ndarray, poly: np.ndarray, n: int) -> np.ndarray:
    """``polygon, y, x0, x1`` of the tiles that each edge meets in each row."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    top, bottom = np.maximum(_row_of(high, n) - 1, 0), np.minimum(_row_of(low, n) + 1, n - 1)
    edge, y = wkb.ragged(top, np.maximum(bottom - top + 1, 0))
    north, south = _latitude(y, n), _latitude(y + 1, n)
    meets = (low[edge] <= north) & (high[edge] >= south)
    edge, y, north, south = edge[meets], y[meets], north[meets], south[meets]
    x1, y1, x2, y2 = e[edge].T
    rise = np.where(y2 == y1, 1.0, y2 - y1)

    def at(lat):
        """Longitude of the edge where it leaves the row, or its end within."""
        return np.where(y2 == y1, x1, x1 + (np.clip(lat, low[edge], high[edge]) - y1) * (x2 - x1) / rise)

    a, b = at(south), at(north)
    flat = y1 == y2
    west, east = np.minimum(e[edge, 0], e[edge, 2]), np.maximum(e[edge, 0], e[edge, 2])
    left = np.where(flat, west, np.clip(np.minimum(a, b), west, east))
    right = np.where(flat, east, np.clip(np.maximum(a, b), west, east))
    first, last = _columns(left, right, n)
    return np.stack([poly[edge], y, first, last])[:, first <= last]


def _inner_tiles(e: np.ndarray, poly: np.ndarray, n: int) -> np.ndarray:
    """``polygon, y, x0, x1`` between the crossings of the middle of each row, two by two."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    top, bottom = np.maximum(_row_of(high, n) - 1, 0), np.minimum(_row_of(low, n) + 1, n - 1)
    edge, y = wkb.ragged(top, np.maximum(bottom - top + 1, 0))
    middle = (_latitude(y, n) + _latitude(y + 1, n)) / 2
    crosses = (low[edge] <= middle) & (middle < high[edge])
    edge, y, middle = edge[crosses], y[crosses], middle[crosses]
    x1, y1, x2, y2 = e[edge].T
    x = x1 + (middle - y1) * (x2 - x1) / np.where(y2 == y1, 1.0, y2 - y1)
    order = np.lexsort((x, y, poly[edge]))
    owner, y, x = poly[edge][order], y[order], x[order]
    first, last = _columns(x[::2], x[1::2], n)
    return np.stack([owner[::2], y[::2], first, last])[:, first <= last]


def _merged(runs: np.ndarray, n: int) -> np.ndarray:
    """Runs of one row of one polygon that meet or follow each other, joined."""
    owner, y, first, last = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    if not len(owner):
        return np.stack([owner, y, first, last])
    group = np.cumsum(np.concatenate([[0], (np.diff(owner) != 0) | (np.diff(y) != 0)])) * (2 * n)
    reach = np.maximum.accumulate(last + group)
    begin = np.concatenate([[True], (first + group)[1:] > reach[:-1] + 1])
    at = np.flatnonzero(begin)
    end = np.append(at[1:], len(owner)) - 1
    return np.stack([owner[at], y[at], first[at], (reach - group)[end]])


def box_wkb(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Axis-aligned box as a WKB polygon, counter-clockwise."""

    @F.arrow_udf("binary")
    def kernel(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
        cols = [c.to_numpy(zero_copy_only=False).astype("<f8") for c in (x1, y1, x2, y2)]
        a, b, c, d = cols
        xy = np.stack([a, b, c, b, c, d, a, d, a, b], axis=1)
        head = wkb.struct.pack("<BIII", 1, wkb.POLYGON, 1, 5)
        blank = np.isnan(xy).any(axis=1)
        return pa.array(
            [None if gone else head + row.tobytes() for row, gone in zip(xy, blank, strict=True)],
            pa.binary(),
        )

    return kernel(minx, miny, maxx, maxy)


def box_geojson(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """The same box as GeoJSON text."""
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    ring = F.array(*[F.array(x, y) for x, y in corners])
    return F.to_json(
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    )


def box_edges(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Edge list of a box, as ``parts`` would give it."""
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    flat = []
    for (x1, y1), (x2, y2) in zip(corners, corners[1:], strict=False):
        flat += [x1, y1, x2, y2]
    return F.array(*flat)
