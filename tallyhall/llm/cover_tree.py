"""Near-duplicate vectors by dual traversal of cover trees.

The top of the tree is a net of at most :data:`MAX_CELLS` centres, picked farthest first
from a bounded sample, and every vector belongs to the nearest. Each cell is cut into blocks
of bounded size; equal vectors meet in one block, where one stands for all and counts as
often. Each block gets a cover tree: nested levels of nodes whose radii halve, down to
the vectors. Pairs of cells, of blocks and of nodes are dropped where the angle of their
centres exceeds the sum of their covering radii and the angle of the threshold. Single
vectors are compared folded first: a part of their turned components, and the length of
the rest as one more, have a product that is never less. What is left at the bottom is
compared exactly, in double precision. The sample decides how the work is cut, never what links.

Vectors travel once, to their block, in the type they came in. Blocks are stored, and pairs
of blocks are read from there, side by side: no block is copied to disk for its pairs.

A pair of blocks reports, for each vector, how many it links with, and a spanning forest
of the links: no list of all pairs is ever made. Vectors that are null, empty, zero or
hold null or non-finite parts link with nothing, nor do those of a null id; vectors of
different lengths never link. A repeated row is a vector of its own. An empty table gives
an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import BATCH_BYTES, materialise, small_batches, smallest
from tallyhall.llm.graph import components
from tallyhall.llm.vectors import doubles, finite, matrix

THRESHOLD = 0.95
BLOCK = 4096
MAX_CELLS = 256
SAMPLE = 2048
FILES = 2000  # files that blocks are written to, at most
FOLD = 4  # single vectors are compared by a fourth of their components first
SLACK = 1e-5  # bounds, in single precision, are loosened by it, so rounding never drops a pair
FINEST = np.pi / 64


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def net(points: np.ndarray, count: int) -> np.ndarray:
    """Centres farthest first: each next one is the point farthest from those before."""
    chosen, best = [0], points @ points[0]
    while len(chosen) < count and best.min() < 1 - 1e-9:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, points @ points[chosen[-1]])
    return points[chosen]


def turned(dim: int) -> np.ndarray:
    """Orthonormal columns that make a FOLDth of ``dim``, the same in every task."""
    return np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, -(-dim // FOLD))))[0]


class Tree:
    """Nested levels of nodes over a block; the last level's nodes hold the points.

    Built once for each block; ``parts`` is what to keep of it beside the points.
    """

    def __init__(self, points: np.ndarray, parts: bytes | None = None):
        self.points, self.coarse, self.folds = points, points.astype(np.float32), None
        if parts is None:
            self._build(points)
        else:
            self.levels, self.parents, self.radii, self.inside = pickle.loads(parts)

    def parts(self) -> bytes:
        return pickle.dumps((self.levels, self.parents, self.radii, self.inside))

    def _build(self, points: np.ndarray) -> None:
        levels, nodes, radius = [np.array([0])], [0], np.pi / 2
        best = points @ points[0]
        while radius > FINEST and len(nodes) < len(points):
            bound = np.cos(radius)
            while True:
                bare = np.flatnonzero(best < bound)
                if not len(bare) or 2 * len(nodes) > len(points):
                    break
                nodes.append(int(bare[0]))
                best = np.maximum(best, points @ points[nodes[-1]])
            radius /= 2
            if 2 * len(nodes) > len(points):  # nodes of a point or two save little
                levels.append(np.arange(len(points)))
                break
            if len(nodes) > len(levels[-1]):  # else the level is as the one above
                levels.append(np.array(nodes))
        self.levels = levels
        inside = np.empty(len(points), np.int64)
        if self.single():
            inside[levels[-1]] = np.arange(len(points))
        else:
            inside = self._nearest(points, levels[-1])
        self.parents, self.radii = [], []
        held = inside  # node of each point at the level in hand
        for depth in range(len(levels) - 1, -1, -1):
            away = angles(np.einsum("ij,ij->i", points, points[levels[depth]][held]))
            radii = np.zeros(len(levels[depth]))
            np.maximum.at(radii, held, away)
            if len(radii) == len(points):
                radii[:] = 0.0  # a point's angle with itself, rounded
            self.radii.insert(0, radii)
            if depth:
                parent = self._nearest(points[levels[depth]], levels[depth - 1])
                self.parents.insert(0, parent)
                held = parent[held]
        self.parents.insert(0, np.zeros(1, np.int64))
        self.inside = inside
        for held in (self.levels, self.parents):
            held[:] = [a.astype(np.int32) for a in held]
        self.inside = inside.astype(np.int32)

    def _nearest(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        out = np.empty(len(points), np.int64)
        for i in range(0, len(points), 512):
            out[i : i + 512] = (points[i : i + 512] @ self.points[nodes].T).argmax(axis=1)
        return out

    def at(self, depth: int):
        depth = min(depth, len(self.levels) - 1)
        return self.coarse[self.levels[depth]], self.radii[depth].astype(np.float32)

    def down(self, depth: int) -> np.ndarray:
        """Parent, a level up, of each node at this depth; below the last level, itself."""
        return self.parents[depth] if depth < len(self.levels) else np.arange(len(self.levels[-1]))

    def single(self) -> bool:
        """Whether the last level's nodes are the points themselves."""
        return len(self.levels[-1]) == len(self.points)

    def folded(self) -> np.ndarray:
        """Points of fewer components whose products are never below those of the points."""
        if self.folds is None:
            head = self.points @ turned(self.points.shape[1])
            rest = np.sqrt(np.maximum(1.0 - np.einsum("ij,ij->i", head, head), 0.0))
            self.folds = np.column_stack([head, rest]).astype(np.float32)
        return self.folds


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that are set; a mask that is mostly empty is read eight bytes at a time."""
    flat = mask.ravel()
    if flat.size % 8 == 0:
        words = np.flatnonzero(flat.view(np.uint64))
        found = (words[:, None] * 8 + np.arange(8)).ravel()
        found = found[flat[found]]
    else:
        found = np.flatnonzero(flat)
    return np.divmod(found, mask.shape[1])


def exact(x: Tree, y: Tree, rows: np.ndarray, cols: np.ndarray, near: np.ndarray, threshold: float):
    """Points of x and of y that link, among ``rows`` and ``cols`` where ``near``; sorted by rows."""
    if np.count_nonzero(near) * 32 < near.size:
        i, j = places(near)
        i, j = rows[i], cols[j]
        link = np.empty(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            link[part] = np.einsum("ij,ij->i", x.points[i[part]], y.points[j[part]]) >= threshold
        return i[link], j[link]
    some = near.any(axis=0)
    i, j = ((x.points[rows] @ y.points[cols[some]].T >= threshold) & near[:, some]).nonzero()
    return rows[i], cols[some][j]


def meets(x: Tree, y: Tree, threshold: float):
    """Yields ``(points of x, points of y)`` of every exact link, those of one of x together."""
    tau = np.float32(np.arccos(threshold) + SLACK)
    alive = np.ones((1, 1), bool)
    single = x.single() and y.single()
    depths = max(len(x.levels), len(y.levels))
    for depth in range(depths):
        (cx, rx), (cy, ry) = x.at(depth), y.at(depth)
        up_x, up_y = x.down(depth), y.down(depth)
        if depth == 0:
            up_x, up_y = np.zeros(len(cx), np.int64), np.zeros(len(cy), np.int64)
        rows = np.flatnonzero(alive.any(axis=1)[up_x])
        cols = np.flatnonzero(alive.any(axis=0)[up_y])
        if not len(rows) or not len(cols):
            return
        if single and depth == depths - 1:
            folds_x, folds_y = (t.folded()[t.levels[-1][at]] for t, at in ((x, rows), (y, cols)))
            for i in range(0, len(rows), 512):
                r = rows[i : i + 512]
                near = folds_x[i : i + 512] @ folds_y.T >= np.float32(threshold - SLACK)
                yield exact(x, y, x.levels[-1][r], y.levels[-1][cols], near, threshold)
            return
        now, every = np.zeros((len(cx), len(cy)), bool), bool(alive.all())
        cy, ry = cy[cols], ry[cols]
        cos_y, sin_y = np.cos(ry), np.sin(ry)
        for i in range(0, len(rows), 512):
            r = rows[i : i + 512]
            cosines, reach = cx[r] @ cy.T, tau + rx[r]
            if rx[r].any() or ry.any():
                bound = np.cos(reach)[:, None] * cos_y - np.sin(reach)[:, None] * sin_y
                near = (cosines >= bound - SLACK) | (reach[:, None] + ry >= np.pi - SLACK)
            else:  # nodes of single points
                near = cosines >= np.cos(tau) - SLACK
            if not every:
                near &= alive[np.ix_(up_x[r], up_y[cols])]
            now[np.ix_(r, cols)] = near
        alive = now
    open_rows = np.flatnonzero(alive.any(axis=1)[x.inside])
    cols = np.flatnonzero(alive.any(axis=0)[y.inside])
    for i in range(0, len(open_rows), 512):
        r = open_rows[i : i + 512]
        yield exact(x, y, r, cols, alive[np.ix_(x.inside[r], y.inside[cols])], threshold)


class Forest:
    """Keeps one link for each two groups that a row of links joins."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.label = ids, np.arange(len(ids))
        self.links: list[tuple[int, int]] = []

    def join(self, members: np.ndarray) -> None:
        labels = self.label[members]
        least = labels.min()
        if (labels == least).all():
            return
        others = np.unique(labels[labels != least])
        self.links += [(int(self.ids[o]), int(self.ids[least])) for o in others]
        self.label[np.isin(self.label, others)] = least


def compare(x_ids, x_weights, x: Tree, y_ids, y_weights, y: Tree, same: bool, threshold: float):
    """Links of each vector, weighted by copies, and a spanning forest of the links."""
    counts_x, counts_y = np.zeros(len(x_ids), np.int64), np.zeros(len(y_ids), np.int64)
    forest = Forest(x_ids if same else np.concatenate([x_ids, y_ids]))
    for i, j in meets(x, y, threshold):
        if same:
            i, j = i[i != j], j[i != j]
        if not len(i):
            continue
        np.add.at(counts_x, i, y_weights[j])
        if not same:
            np.add.at(counts_y, j, x_weights[i])
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        for row, linked in zip(i[starts], np.split(j if same else j + len(x_ids), starts[1:])):
            forest.join(np.append(linked, row))
    counts = [(x_ids, counts_x)] if same else [(x_ids, counts_x), (y_ids, counts_y)]
    return counts, forest.links


def keys(points: np.ndarray) -> list[bytes]:
    """A digest of each row; zeros of either sign are one."""
    return [hashlib.blake2b(row, digest_size=16).digest() for row in points.astype("<f8") + 0.0]


def by_length(batch: pa.RecordBatch):
    """Row numbers and vectors of a batch, for each length."""
    lengths = batch.column("embedding").value_lengths().to_numpy()
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, matrix(batch.column("embedding").take(pa.array(at)), int(dim))


def copies(vectors: DataFrame, centres: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Vectors with their cells, as bytes of type ``kind``; equal ones a task sees are counted.

    A task keeps about BATCH_BYTES of vectors in mind, so a vector that half the rows
    repeat leaves it a few times and not as often as it stands there.
    """

    def count(batches):
        held: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for dim, at, found in by_length(batch):
                cells = (unit(found) @ centres[dim].T).argmax(axis=1) if dim in centres else np.zeros(len(at), int)
                raw = found.astype(kind)
                for k, cell, id_, row in zip(keys(found), cells.tolist(), ids[at].tolist(), raw):
                    if k in held:
                        held[k][3] = min(held[k][3], id_)
                        held[k][4] += 1
                    else:
                        held[k] = [dim, cell, k, id_, 1, row.tobytes()]
                        size += len(held[k][5])
            if size > BATCH_BYTES:
                yield packed(held)
                held, size = {}, 0
        if held:
            yield packed(held)

    def packed(held):
        types = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        names = ["dim", "cell", "key", "id", "weight", "point"]
        columns = zip(*held.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return vectors.mapInArrow(count, "dim int, cell int, key binary, id long, weight long, point binary")


def marked(vectors: DataFrame) -> DataFrame:
    """``vec_id, key`` of each row."""

    def mark(batches):
        for batch in batches:
            out = np.empty(batch.num_rows, object)
            for _, at, found in by_length(batch):
                out[at] = keys(found)
            columns = [batch.column("vec_id"), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "key"])

    return vectors.mapInArrow(mark, "vec_id long, key binary")


BLOCKS = "block string, dim int, cell int, radius double, ids binary, weights binary, keys binary, points binary, tree binary"
SIDE = ["block", "ids", "weights", "points", "tree"]


def link_table(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    every = doubles(vectors)
    some = F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    valid = small_batches(every.filter(finite() & some & F.col("vec_id").isNotNull()))
    total, count = valid.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("embedding"))).first()
    drawn = smallest(valid, F.xxhash64("vec_id", "embedding"), SAMPLE, total).select("embedding").collect()
    sample = [np.array(r["embedding"]) for r in drawn]
    centres = {}
    for dim in {len(v) for v in sample}:
        found = unit(np.array([v for v in sample if len(v) == dim]))
        centres[dim] = net(found, max(1, min(MAX_CELLS, -(-count // BLOCK))))

    placed = copies(valid, centres, kind)
    distinct = placed.groupBy("dim", "cell").agg(F.approx_count_distinct("key", 0.02).alias("n"))
    cuts = materialise(distinct.select("dim", "cell", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("cuts")), "cuts")
    files = max(1, min(FILES, cuts.agg(F.sum("cuts")).first()[0] or 1))
    dealt = placed.join(F.broadcast(cuts), ["dim", "cell"]).withColumn("cut", F.pmod(F.xxhash64("key"), "cuts").cast("int"))
    dealt = dealt.drop("cuts").repartition(files, "dim", "cell", "cut")

    def block(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, cell, cut = (int(k.as_py()) for k in key)
        held: dict[bytes, int] = {}
        ids, weights, raw = [], [], bytearray()
        for batch in batches:
            columns = (batch.column(c) for c in ("key", "id", "weight"))
            for n, (k, id_, weight) in enumerate(zip(*(c.to_pylist() for c in columns))):
                at = held.setdefault(k, len(ids))
                if at == len(ids):
                    ids.append(id_)
                    weights.append(weight)
                    raw += batch.column("point")[n].as_py()
                else:
                    ids[at] = min(ids[at], id_)
                    weights[at] += weight
        points = unit(np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64))
        centre = centres[dim][cell] if dim in centres else points[0] * 0
        radius = float(angles(points @ centre).max()) if dim in centres else np.pi
        ids, weights = (np.array(c, "<i8").tobytes() for c in (ids, weights))
        row = {"block": f"{dim}/{cell}/{cut}", "dim": dim, "cell": cell, "radius": radius}
        row |= {"ids": ids, "weights": weights, "keys": b"".join(held), "points": bytes(raw)}
        row["tree"] = Tree(points).parts()
        types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

    blocks = materialise(dealt.groupBy("dim", "cell", "cut").applyInArrow(block, BLOCKS), "blocks")
    # Pairs of cells whose balls come near enough: at most MAX_CELLS for each length, so a short list.
    tau = float(np.arccos(threshold)) + SLACK
    widest = {(r["dim"], r["cell"]): r["r"] for r in blocks.groupBy("dim", "cell").agg(F.max("radius").alias("r")).collect()}
    near = []
    for dim, cell in widest:
        others = []
        for other in (c for d, c in widest if d == dim):
            apart = float(angles(centres[dim][cell] @ centres[dim][other])) if dim in centres else 0.0
            if apart <= tau + widest[dim, cell] + widest[dim, other]:
                others.append(other)
        near.append((dim, cell, others))
    cells = spark.createDataFrame(near, "dim int, cell int, near array<int>")
    # Each two parts of the stored blocks are read by a task: a product of tables is not shuffled.
    left = blocks.join(F.broadcast(cells), ["dim", "cell"]).select("dim", "near", *SIDE)
    right = blocks.select(F.col("dim").alias("dim2"), F.col("cell").alias("cell2"), *[F.col(c).alias(f"{c}2") for c in SIDE])
    wanted = (F.col("block") <= F.col("block2")) & F.expr("dim = dim2 and array_contains(near, cell2)")
    pairs = left.hint("shuffle_replicate_nl").join(right, wanted).select("dim", *SIDE, *[f"{c}2" for c in SIDE])

    def meet(batches):
        last = [None, None]

        def side(batch, n, dim, end):
            name, ids, weights, points, tree = (batch.column(c + end)[n].as_py() for c in SIDE)
            if last[0] == name:
                return last[1]
            found = unit(np.frombuffer(points, kind).reshape(-1, dim).astype(np.float64))
            made = (np.frombuffer(ids, "<i8"), np.frombuffer(weights, "<i8"), Tree(found, tree))
            if not end:
                last[:] = name, made
            return made

        for batch in batches:
            for n in range(batch.num_rows):
                x, y = (side(batch, n, batch.column("dim")[n].as_py(), end) for end in ("", "2"))
                counts, links = compare(*x, *y, x is y, threshold)
                ids = np.concatenate([i[n > 0] for i, n in counts])
                number = np.concatenate([n[n > 0] for _, n in counts])
                a, b = np.array(links, np.int64).reshape(-1, 2).T
                others = pa.array([None] * len(ids) + b.tolist(), pa.int64())
                columns = [np.concatenate([ids, a]), np.concatenate([number, np.zeros(len(a), np.int64)]), others]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "n", "other"])

    found = materialise(small_batches(pairs).mapInArrow(meet, "id long, n long, other long"), "vector-links")
    counts = found.filter("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    linked = components(found.filter("other is not null"), "id", "other")

    def members(batches):
        for batch in batches:
            for held, ids, weights in zip(*(batch.column(c).to_pylist() for c in ("keys", "ids", "weights"))):
                numbers = [pa.array(np.frombuffer(c, "<i8")) for c in (ids, weights)]
                held = pa.array([held[i : i + 16] for i in range(0, len(held), 16)], pa.binary())
                yield pa.RecordBatch.from_arrays([held, *numbers], ["key", "id", "weight"])

    reps = blocks.select("keys", "ids", "weights").mapInArrow(members, "key binary, id long, weight long")
    classes = (
        reps.join(counts, "id", "left")
        .join(linked, "id", "left")
        .select(
            "key",
            (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    good = marked(valid).join(classes, "key").select("vec_id", "n_links", "component_id")
    bad = every.filter(~(finite() & some & F.col("vec_id").isNotNull()))
    bad = bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
