"""Polygon joins on a hierarchical grid, largest-overlap assignment, tile pruning.

A spatial predicate alone would make Spark compare every pair of rows. Here each
polygon is covered by a few cells of a grid whose cell size follows the size of
the polygon, cells are joined by equality, boxes are compared in the same join,
and only the surviving pairs reach the exact kernel.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhall.functions import geometry as geo
from tallyhall.functions import tiles as tl
from tallyhall.functions.text import class_code
from tallyhall.session import materialise

BOX = ["minx", "miny", "maxx", "maxy"]
CELL = ["grid", "cx", "cy"]
RATIO_BITS = 3  # cell sides grow by 2**3 from one level to the next
SMALLEST = 1e-9  # extents below this share the finest level
PROBE_ROWS = 4_000_000  # rows looked at to find crowded cells
HOT_SHARE = 512  # a cell with more than 1/512 of the rows is crowded
MIN_HOT = 100_000  # cells below this many rows are never split
MERGE_PIECES = 100_000  # with more pieces on both sides, kernels meet whole cells
MERGE_ROWS = 20_000  # pieces of a task, and rows a kernel takes at once, about
MERGE_TASKS = 20_000
MERGE_DOUBLES = 1 << 20  # coordinates that a kernel copies for pairs at once


def prepare(
    df: DataFrame, geom: str, cols: list[str], mode: str, row_id: str, prefix: str
) -> DataFrame:
    """Number the rows, parse every geometry once and write one row per piece.

    Row numbers must not change when a lost task runs again, hence the written
    table. Later steps read only the columns they need from it; the geometry is
    kept with the first piece alone.
    """
    numbered = df.select(
        F.monotonically_increasing_id().alias(row_id),
        *[F.col(c) for c in cols],
        F.col(geom),
        geo.pieces(F.col(geom), mode).alias("_p"),
    )
    cut = numbered.select(
        row_id, *cols, geom, F.col("_p.area").alias(f"{prefix}area"),
        F.posexplode_outer(F.arrays_zip("_p.edges", "_p.boxes")).alias("_n", "_z"),
    )
    first = F.coalesce("_n", F.lit(0)) == 0
    flat = cut.select(
        row_id, first.alias("_first"), *cols, F.when(first, F.col(geom)).alias(geom),
        f"{prefix}area", F.col("_z.edges").alias(f"{prefix}edges"),
        *[F.col(f"_z.boxes.{c}").alias(prefix + c) for c in BOX],
    )
    leveled = flat.withColumn(f"{prefix}level", _level(prefix))
    return materialise(leveled, f"prepared-{row_id.strip('_')}")


def _payload(prepared: DataFrame, cols: list[str]) -> DataFrame:
    """One row per input row again."""
    return prepared.filter("_first").select(*cols)


def _pieces(prepared: DataFrame, prefix: str, keep: list[str | Column]) -> DataFrame:
    """Boxes and levels of all pieces, with the columns to ``keep``."""
    found = prepared.filter(F.col(f"{prefix}level").isNotNull())
    return found.select(*keep, *[prefix + c for c in BOX], f"{prefix}level")


def _level(p: str) -> Column:
    """Grid level whose cell side is between a quarter of the extent and twice it."""
    extent = F.greatest(
        F.col(f"{p}maxx") - F.col(f"{p}minx"), F.col(f"{p}maxy") - F.col(f"{p}miny"),
        F.lit(SMALLEST),
    )
    return F.ceil((F.log2(extent) - 2) / RATIO_BITS).cast("int")


def _levels(boxes: DataFrame, prefix: str) -> dict[int, int]:
    """Pieces per level in use: at most one level per eightfold size, a handful."""
    return {r[0]: r["count"] for r in boxes.groupBy(f"{prefix}level").count().collect()}


def _cell(c: Column, level: Column) -> Column:
    return F.floor(c / F.pow(F.lit(2.0), level * RATIO_BITS)).cast("long")


def _cover(df: DataFrame, p: str, grids: Column) -> DataFrame:
    """One row per (grid, cell) the box of ``df`` covers, for the grids listed."""
    level = F.floor(F.col("grid") / 2)

    def run(low: str, high: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(p + low), level), _cell(F.col(p + high), level)))

    return (
        df.withColumn("grid", F.explode(grids))
        .withColumn("cx", run("minx", "maxx"))
        .withColumn("cy", run("miny", "maxy"))
    )


def _crowded(cells: DataFrame, fraction: float) -> dict[tuple, int]:
    """Cells that hold more than 1/HOT_SHARE of the rows, with their salt count.

    Looking at a share of the rows is enough to find them; it decides only how
    work is dealt out, never which pairs are found. At most HOT_SHARE cells.
    """
    counts = cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(MIN_HOT * fraction, total / HOT_SHARE)
    if total <= limit:
        return {}
    found = counts.filter(F.col("n") > limit).collect()
    return {(r.grid, r.cx, r.cy): int(-(-r.n // limit)) for r in found}


def _cells(left: DataFrame, right: DataFrame, left_part: list, right_part: list):
    """Cells of both sides, the columns cells are equal by, and the pieces of each side.

    A pair meets on the level of its larger member: the larger is covered at its
    own level only, the smaller at every level the other side uses above its own.
    Even grid numbers are for right >= left, odd ones for left > right. Crowded cells
    are cut in both directions: left pieces over ``ls`` salts, right ones over ``rs``
    salts, each repeated along the other's.
    """
    l_boxes, r_boxes = (_pieces(d, p, []) for d, p in ((left, "l_"), (right, "r_")))
    l_levels, r_levels = _levels(l_boxes, "l_"), _levels(r_boxes, "r_")

    def grids(own: str, odd: int, others: dict[int, int], strict: bool) -> Column:
        level = F.col(own)
        above = [
            F.when((F.lit(m) > level) if strict else (F.lit(m) >= level), m * 2 + odd)
            for m in others
        ]
        lowest = min(others, default=None)  # no smaller partner, no row for it
        has_smaller = (level >= lowest) if strict else (level > lowest)
        return F.array_compact(F.array(F.when(has_smaller, level * 2 + (1 - odd)), *above))

    l_grids, r_grids = grids("l_level", 0, r_levels, False), grids("r_level", 1, l_levels, True)
    l_cells = _cover(_pieces(left, "l_", ["_lid", "l_area", "l_edges", *left_part]), "l_", l_grids)
    r_keep = ["_rid", "r_area", "r_edges", *right_part]
    r_cells = _cover(_pieces(right, "r_", r_keep), "r_", r_grids)

    crowded = {}
    sides = ((l_boxes, "l_", l_levels, l_grids), (r_boxes, "r_", r_levels, r_grids))
    for side, (boxes, box, levels, own_grids) in enumerate(sides):
        n = sum(levels.values())
        if n <= MIN_HOT:
            continue
        share = min(1.0, PROBE_ROWS / n)
        probe = _cover(boxes.sample(share, seed=7), box, own_grids)
        for cell, salts in _crowded(probe, share).items():
            crowded.setdefault(cell, [1, 1])[side] = salts

    keys = list(CELL)
    if crowded:
        rows = [(*cell, *salts) for cell, salts in crowded.items()]
        table = left.sparkSession.createDataFrame(
            rows, "grid int, cx long, cy long, l_salts int, r_salts int"
        )
        l_cells = _deal(l_cells, table, "l_salts", "ls", ["_lid", "l_minx"], "r_salts", "rs")
        r_cells = _deal(r_cells, table, "r_salts", "rs", ["_rid", "r_minx"], "l_salts", "ls")
        keys += ["ls", "rs"]
    return l_cells, r_cells, keys, sum(l_levels.values()), sum(r_levels.values())


def _joined(l_cells: DataFrame, r_cells: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of pieces whose boxes meet, each exactly once, by a join of their cells.

    Of the cells a pair shares, the one with the lower-left corner of the common box
    counts.
    """
    lc, rc = l_cells.alias("a"), r_cells.alias("b")
    conditions = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    level = F.floor(F.col("a.grid") / 2)
    for axis, cell in (("x", "cx"), ("y", "cy")):
        low = F.greatest(f"l_min{axis}", f"r_min{axis}")
        conditions += [
            low <= F.least(f"l_max{axis}", f"r_max{axis}"),
            F.col(f"a.{cell}") == _cell(low, level),
        ]
    joined = lc.join(rc, reduce(lambda x, y: x & y, conditions))
    return joined.drop("grid", "cx", "cy", "ls", "rs")


def _deal(
    cells: DataFrame, crowded: DataFrame, own: str, salt: str, piece: list[str],
    other: str, along: str,
) -> DataFrame:
    """Give each piece one of its own salts and a copy per salt of the other side."""
    return (
        cells.join(F.broadcast(crowded), CELL, "left")
        .withColumn(salt, F.pmod(F.xxhash64(*piece), F.coalesce(own, F.lit(1))).cast("int"))
        .withColumn(along, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
        .drop("l_salts", "r_salts")
    )


def _merged(l_cells: DataFrame, r_cells: DataFrame, keys: list[str], tasks: int, mode: str) -> DataFrame:
    """Left pieces with a list of the right ones they meet, from kernels over whole cells.

    Tasks read cells in order, both sides of each. Only pieces travel to a kernel, and
    back from it only what meets: no row is made for a pair of boxes.
    """
    owns = {c: l_cells.schema[c].dataType for c in l_cells.columns if c in ("_lid", "l_area") or c.startswith("_l_")}
    others = {c: r_cells.schema[c].dataType for c in ("_rid", "_r")}

    def side(cells: DataFrame, p: str, n: int) -> DataFrame:
        level = F.floor(F.col("grid") / 2)
        low = [(_cell(F.col(f"{p}min{axis}"), level) == F.col(f"c{axis}")).cast("double") for axis in "xy"]
        box = F.array(*[F.col(p + c) for c in BOX], *low, F.col(f"{p}area"))
        every = {"l_area": "double"} | {c: kind for c, kind in (owns | others).items()}
        return cells.select(
            *keys, F.lit(n).alias("side"), F.col(f"{p}edges").alias("edges"), box.alias("box"),
            *[(F.col(c) if c in cells.columns else F.lit(None)).cast(kind).alias(c) for c, kind in every.items()],
        )

    both = side(l_cells, "l_", 0).unionByName(side(r_cells, "r_", 1))
    dealt = both.repartition(tasks, *keys).sortWithinPartitions(*keys)
    pair = T.StructType([T.StructField(c, kind) for c, kind in others.items()]).add("intersection_area", "double")
    schema = T.StructType([T.StructField(c, kind) for c, kind in owns.items()]).add("_m", T.ArrayType(pair))

    def meet(table: pa.Table, cell: np.ndarray):
        """Rows of a table of whole cells, numbered by ``cell``."""
        of = table.column("side").to_numpy()
        rows = [np.flatnonzero(of == n) for n in (0, 1)]
        flat = [table.take(r).combine_chunks() for r in rows]
        boxes = [t.column("box").combine_chunks().flatten().to_numpy().reshape(-1, 7) if len(t) else np.empty((0, 7)) for t in flat]
        lengths = [np.bincount(cell[r], minlength=cell[-1] + 1) for r in rows]
        (l, r), (a, b) = flat, boxes
        if not len(a) or not len(b):
            return
        edges = [t.column("edges").combine_chunks() for t in flat]
        counts = [e.value_lengths().to_numpy() for e in edges]
        held, size = [], 0
        for pairs in (*geo.box_pairs(a, lengths[0], b, lengths[1]), None):
            if pairs is not None:
                held.append(pairs)
                size += len(pairs[0])
            if not size or pairs is not None and size < 1 << 16:
                continue
            i, j = (np.concatenate(c) for c in zip(*held, strict=True))
            held, size = [], 0
            weight = np.cumsum(counts[0][i] + counts[1][j] + 32) // MERGE_DOUBLES
            for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(weight)) + 1):
                yield report(l, r, a, b, edges, i[part], j[part])

    def report(l, r, a, b, edges, i, j):
        x, y = (e.take(pa.array(at)) for e, at in zip(edges, (i, j), strict=True))
        low, high = np.maximum(a[i, 0], b[j, 0]), np.minimum(a[i, 2], b[j, 2])
        area = geo.overlap_areas(x, y, low, high, np.minimum(a[i, 6], b[j, 6]), mode)
        some = ~np.isnan(area)
        i, j, area = i[some], j[some], area[some]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        right = [r.column(c).combine_chunks().take(pa.array(j)) for c in others]
        found = pa.StructArray.from_arrays([*right, pa.array(area)], [*others, "intersection_area"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(i)), pa.int32()), found)
        left = [l.column(c).combine_chunks().take(pa.array(i[starts])) for c in owns]
        return pa.RecordBatch.from_arrays([*left, lists], [*owns, "_m"])

    def kernel(batches):
        held, size, wanted = [], 0, MERGE_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= wanted:
                table, cell = numbered(held)
                whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
                if whole:
                    yield from meet(table.slice(0, whole), cell[:whole])
                held = table.slice(whole).to_batches()
                size = len(table) - whole
                wanted = max(MERGE_ROWS, 2 * size)
        if size:
            yield from meet(*numbered(held))

    def numbered(held):
        table = pa.Table.from_batches(held)
        new = np.zeros(len(table), bool)
        for c in keys:
            new[1:] |= np.diff(table.column(c).to_numpy()) != 0
        return table, np.cumsum(new)

    return dealt.mapInArrow(kernel, schema)


def matches(
    left: DataFrame, right: DataFrame, right_cols: list[str], mode: str, left_cols: list[str] | None = None
) -> DataFrame:
    """Intersecting pairs of prepared rows: _lid, _rid, l_area, _r, intersection_area.

    Only ids, edges and right columns travel; the left payload is joined back
    later, unless ``left_cols`` are asked for, which come as ``_l_0`` and so on where nothing was cut.
    Pairs of pieces are summed only where a polygon was cut. Few pieces on one side are
    left to Spark's join, which can send them to all tasks; else kernels meet whole cells.
    """
    # A column may carry one name on both sides, so right columns go in a struct.
    r = F.struct(*[F.col(c) for c in right_cols]).alias("_r")
    cut = not (left.filter("not _first").isEmpty() and right.filter("not _first").isEmpty())
    part = [] if cut else [F.col(c).alias(f"_l_{k}") for k, c in enumerate(left_cols or [])]
    l_cells, r_cells, keys, n_left, n_right = _cells(left, right, part, [r])
    own = ["_lid", "l_area", *[f"_l_{k}" for k in range(len(part))]]
    if min(n_left, n_right) > MERGE_PIECES:
        shuffles = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(MERGE_TASKS, max(shuffles, (n_left + n_right) // MERGE_ROWS))
        found = _merged(l_cells, r_cells, keys, tasks, mode).select(*own, F.explode("_m").alias("_m"))
        found = found.select(*own, "_m._rid", "_m._r", "_m.intersection_area")
    else:
        pairs = _joined(l_cells, r_cells, keys)
        area = geo.edges_overlap(
            F.col("l_edges"), F.col("r_edges"),
            F.greatest("l_minx", "r_minx"), F.least("l_maxx", "r_maxx"),
            F.least("l_area", "r_area"), mode,
        )
        found = pairs.select(*own, "_rid", "_r", area.alias("intersection_area"))
        found = found.filter("intersection_area is not null")
    if cut:
        total = F.sum("intersection_area").alias("intersection_area")
        found = found.groupBy("_lid", "_rid", "l_area", "_r").agg(total)
    return found


def significant(area: Column) -> tuple[Column, Column]:
    """An area of zero or more as power of ten and ten digits; sorted by both, sorted by size."""
    power = F.when(area > 0, F.floor(F.log10(area)).cast("int")).otherwise(F.lit(-400))
    digits = F.when(area > 0, F.round(area / F.pow(F.lit(10.0), power), 9)).otherwise(F.lit(0.0))
    up = digits >= 10
    return power + F.when(up, 1).otherwise(0), F.when(up, F.lit(1.0)).otherwise(digits)


def largest_overlap(pairs: DataFrame) -> DataFrame:
    """Per left row the right columns of greatest overlap, as struct ``_r``.

    Areas are compared to ten significant digits, whatever the size of the left
    polygon; equal ones go to the smallest right columns in order, so the choice is
    repeatable. The aggregate combines map-side.
    """
    power, digits = significant(F.col("intersection_area"))
    best = F.min(F.struct((-power).alias("neg_power"), (-digits).alias("neg_digits"), F.col("_r")))
    return pairs.groupBy("_lid").agg(best.alias("_best")).select("_lid", F.col("_best._r"))


def _check(op: str, kind: str) -> None:
    if op != "st_intersects":
        raise ValueError(f"unsupported predicate {op!r}")
    if kind not in ("inner", "left"):
        raise ValueError("kind is 'inner' or 'left'")


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    left_cols: list[str],
    right_cols: list[str],
    left_geom: str = "geometry",
    right_geom: str = "geometry",
    op: str = "st_intersects",
    kind: str = "left",
    dedup: bool = True,
    mode: str = "geography",
) -> DataFrame:
    """Join polygons that intersect, by default keeping the largest overlap only.

    Gives the left geometry, left columns and right columns; without ``dedup``
    also ``intersection_area``. A left row without a match, or without geometry,
    is kept by ``kind='left'`` with null right columns.
    """
    _check(op, kind)
    a = prepare(left, left_geom, left_cols, mode, "_lid", "l_")
    b = prepare(right, right_geom, right_cols, mode, "_rid", "r_")
    payload = _payload(a, ["_lid", left_geom, *left_cols])
    # All pairs at once: left columns go along, as pairs may be too many to shuffle.
    along = [left_geom, *left_cols] if kind == "inner" and not dedup else []
    found = matches(a, b, right_cols, mode, along)
    if "_l_0" in found.columns:
        given = [F.col(f"_l_{k}").alias(c) for k, c in enumerate(along)]
        return found.select(*given, *_unpack(right_cols), "intersection_area")
    if dedup:
        # One row per left row on both sides: no key can be hot here.
        joined = payload.join(largest_overlap(found), "_lid", kind)
        return joined.select(left_geom, *left_cols, *_unpack(right_cols))
    found = materialise(found, "pairs") if kind == "left" else found
    out = found.join(payload, "_lid").select(
        left_geom, *left_cols, *_unpack(right_cols), "intersection_area"
    )
    if kind == "left":
        alone = payload.join(found.select("_lid").distinct(), "_lid", "left_anti")
        out = out.unionByName(alone.drop("_lid"), allowMissingColumns=True)
    return out


def _unpack(cols: list[str]) -> list[Column]:
    return [F.col(f"_r.{c}").alias(c) for c in cols]


def spatial_anti(
    left: DataFrame,
    mask: DataFrame,
    left_geom: str = "geometry",
    mask_geom: str = "geometry",
    mode: str = "planar",
) -> DataFrame:
    """Left rows whose geometry meets no mask polygon; null geometries stay."""
    cols = [c for c in left.columns if c != left_geom]
    a = prepare(left, left_geom, cols, mode, "_lid", "l_")
    b = prepare(mask, mask_geom, [], mode, "_rid", "r_")
    hit = matches(a, b, ["_rid"], mode).select("_lid").distinct()
    kept = _payload(a, ["_lid", *left.columns]).join(hit, "_lid", "left_anti")
    return kept.drop("_lid")


def footprints_with_census(
    footprints: DataFrame,
    blocks: DataFrame,
    places: DataFrame,
    left_cols: list[str],
    mode: str = "geography",
) -> DataFrame:
    """Each footprint with its census block, its place if any, and its area.

    Footprints outside all blocks are dropped. Both assignments come out of their
    aggregate partitioned by footprint, so joining them back costs one shuffle of
    the footprints.
    """
    block_cols = ["county_fips", "tract", "block", "block_geoid"]
    place_cols = [
        "place_fips", "place_ns", "place_geoid", "place_name", "class_fips_code", "class_fips",
    ]
    b = blocks.select(
        F.col("countyfp20").alias("county_fips"),
        F.col("tractce20").alias("tract"),
        F.col("blockce20").alias("block"),
        F.col("geoid20").alias("block_geoid"),
        "geometry",
    )
    p = places.select(
        F.col("placefp").alias("place_fips"),
        F.col("placens").alias("place_ns"),
        F.col("geoid").alias("place_geoid"),
        F.col("name").alias("place_name"),
        F.col("classfp").alias("class_fips_code"),
        class_code(F.col("classfp")).alias("class_fips"),
        "geometry",
    )
    fp = prepare(footprints, "geometry", left_cols, mode, "_lid", "l_")
    in_block = largest_overlap(
        matches(fp, prepare(b, "geometry", block_cols, mode, "_rid", "r_"), block_cols, mode)
    ).withColumnRenamed("_r", "_block")
    in_place = largest_overlap(
        matches(fp, prepare(p, "geometry", place_cols, mode, "_rid", "r_"), place_cols, mode)
    ).withColumnRenamed("_r", "_place")
    return (
        _payload(fp, ["_lid", "geometry", *left_cols, F.col("l_area").alias("area_sqm")])
        .join(in_block, "_lid")
        .join(in_place, "_lid", "left")
        .select("geometry", *left_cols, "_block.*", "_place.*", "area_sqm")
    )


def tiles_touching(
    masks: DataFrame, zoom: int, geom: str = "geometry", keep: list[str] | None = None
) -> DataFrame:
    """Tiles that meet each mask polygon, and that its bounds cover.

    The polygon itself never leaves its row: a kernel gives the runs of tiles it meets, and
    only those become rows.
    """
    keep = keep or []
    shaped = masks.select(*keep, geo.tile_runs(F.col(geom), zoom).alias("_p")).select(*keep, "_p.*")
    spans = shaped.select(*keep, *tl.tile_ranges(zoom), F.explode("runs").alias("_r"))
    first, last = F.greatest("_x0", "_r.x0"), F.least("_x1", "_r.x1")
    held = spans.filter((F.col("_r.y") >= F.col("_y0")) & (F.col("_r.y") <= F.col("_y1")) & (first <= last))
    tiles = held.select(*keep, F.explode(F.sequence(first, last)).alias("x"), F.col("_r.y").alias("y"))
    return tiles.withColumn("quadkey", tl.quadkey(F.col("x"), F.col("y"), zoom))
