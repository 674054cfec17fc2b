"""Exact top-k by inner product over an impact-ordered index, score at a time.

Candidates are dealt into shards of bounded size. In a shard the postings of each
dimension are grouped by quantised impact (the component, in steps of :data:`STEP`). A
query goes through these segments by descending gain over the least a dimension can give.
After each leg, what is known bounds every candidate's score from below and above; the
search stops only when all but a few provably miss the best ``k`` of the shard, and those
left are scored exactly. The first shard gives every query a score that its k-th best can't
fall below, so that most others end after a leg. The best of all shards are ranked together.

Ties go to the smaller id. Vectors that are null, empty or hold null or non-finite parts
take no part, nor do null ids. Vectors with a scaled component of :data:`LARGE` or more, whose
scores might not fit a long on the way, are scored in whole numbers of any size; a score
beyond 64 bits is held at their limits. Only vectors of the query's length are its candidates. Rows
that share a query's id are not its candidates; other repeated rows are candidates each.
An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import materialise
from tallyhall.llm.vectors import doubles, finite, matrix

SCALE = 1024
STEP = 32
SHARD = 4096
QUERIES = 1024  # queries that meet a shard at once
LEGS = (0.9, 1.0)  # shares of the postings after which bounds are tried
LARGE = 1 << 27  # scaled components up to which sums of products of 512 dimensions fit a long
LIMIT = (1 << 63) - 1
FEW = 16  # a leg is the last if at most one in so many candidates is left


class Index:
    """Segments of a shard: the candidates with one quantised impact in one dimension.

    A candidate is in one segment of each dimension; ``segment`` holds its row of them, so the
    segments that a leg has processed are added up for the candidates still in question only.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n, d = values.shape
        self.segment = np.empty((n, d), np.int32)
        dims, lows, highs, sizes, count = [], [], [], [], 0
        for dim in range(d):
            column = values[:, dim]
            level, own = np.unique(column // STEP, return_inverse=True)
            self.segment[:, dim] = count + own
            low, high = np.full(len(level), np.iinfo(np.int64).max), np.full(len(level), np.iinfo(np.int64).min)
            np.minimum.at(low, own, column)
            np.maximum.at(high, own, column)
            dims.append(np.full(len(level), dim))
            lows.append(low)
            highs.append(high)
            sizes.append(np.bincount(own, minlength=len(level)))
            count += len(level)
        self.dims, self.sizes = np.concatenate(dims), np.concatenate(sizes)
        self.lows, self.highs = np.concatenate(lows).astype(np.float64), np.concatenate(highs).astype(np.float64)

    def search(self, query_id: int, query: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` ids and scores, by score, then id; none need be below ``floor``.

        Segments count in the order of what they can gain over the least of their dimension.
        Of a processed one a candidate's part is known up to the width of a step; of the
        others it gains at most what the best unprocessed segment of the dimension can.
        """
        n, d = self.values.shape
        weight = query[self.dims].astype(np.float64)
        one, two = weight * self.lows, weight * self.highs
        low, high = np.minimum(one, two), np.maximum(one, two)
        base = np.full(d, np.inf)
        np.minimum.at(base, self.dims, low)
        gain, sure = high - base[self.dims], low - base[self.dims]
        order = np.argsort(-gain, kind="stable")
        done = np.cumsum(self.sizes[order])
        slack = 1.0 + 1e-9 * float(np.abs(gain).max(initial=0.0)) * d
        left = np.flatnonzero(self.ids != query_id)
        for share in LEGS:
            end = len(order) if share == 1.0 else int(np.searchsorted(done, share * done[-1]))
            rest = np.zeros(d)
            np.maximum.at(rest, self.dims[order[end:]], gain[order[end:]])
            least, most = np.zeros(len(gain)), rest[self.dims]
            least[order[:end]], most[order[:end]] = sure[order[:end]], gain[order[:end]]
            if not len(left) or len(left) <= k and floor is None:
                break
            own = self.segment[left]
            known, upper = least[own].sum(axis=1), most[own].sum(axis=1) + slack
            bar = -np.inf if floor is None else floor - base.sum()
            if len(left) > k:
                bar = max(bar, np.partition(known, len(left) - k)[len(left) - k])
            left = left[upper >= bar]
            if len(left) * FEW <= n:
                break
        scores = self.values[left] @ query
        best = np.lexsort((self.ids[left], ~scores))[:k]
        return self.ids[left][best], scores[best]


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(1024 x)`` as whole numbers of any size."""
    flat = [int(x) * SCALE if abs(x) >= 1 << 52 else int(np.floor(x * SCALE)) for x in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


def best_of_shard(ids: np.ndarray, values: np.ndarray, asks: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each ``(query_id, vector, floor)`` the best candidates of a shard, and their scores."""
    large = (np.abs(values) * SCALE >= LARGE).any(axis=1)
    small = np.flatnonzero(~large)
    index = Index(ids[small], np.floor(values[small] * SCALE).astype(np.int64)) if len(small) else None
    big = whole(values[large])
    everything = None
    out = []
    for query_id, query, floor in asks:
        if (np.abs(query) * SCALE >= LARGE).any():
            everything = whole(values) if everything is None else everything
            own, scores = ids, _clamped(everything @ whole(query))
        else:
            found = index.search(query_id, np.floor(query * SCALE).astype(np.int64), k, floor) if index else (ids[:0], ids[:0])
            own = np.concatenate([found[0], ids[large]])
            scores = np.concatenate([found[1], _clamped(big @ whole(query)) if len(big) else ids[:0]])
        other = own != query_id
        own, scores = own[other], scores[other]
        best = np.lexsort((own, ~scores))[:k]
        out.append((own[best], scores[best]))
    return out


def _clamped(scores: np.ndarray) -> np.ndarray:
    return np.array([max(-LIMIT - 1, min(LIMIT, int(x))) for x in scores], np.int64)


def _search(theirs: DataFrame, ours: DataFrame, k: int) -> DataFrame:
    """The best of each shard for the queries that are sent to it."""

    def search(key, table):
        dim = int(key[0].as_py())
        ids, asks = table.column("vec_id").to_numpy(), table.column("asks").to_numpy(zero_copy_only=False)
        values = matrix(table.column("embedding"), dim)
        floors = table.column("floor").to_pylist()
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if asks.any() and not asks.all():
            at = np.flatnonzero(asks)
            found = best_of_shard(ids[~asks], values[~asks], [(int(ids[i]), values[i], floors[i]) for i in at], k)
            for i, (own, scores) in zip(at, found):
                out["query_id"].append(np.full(len(own), ids[i]))
                out["vec_id"].append(own)
                out["score"].append(scores)
        none = [np.empty(0, np.int64)]
        return pa.table({c: np.concatenate(none + v).astype(np.int64) for c, v in out.items()})

    columns = ["dim", "shard", "block", "asks", "vec_id", "embedding", "floor"]
    theirs = theirs.withColumn("floor", F.lit(None).cast("long"))
    both = theirs.select(*columns).unionByName(ours.select(*columns))
    return both.groupBy("dim", "shard", "block").applyInArrow(search, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query: its ``k`` best among all vectors."""
    held = materialise(_valid(vectors), "vectors")
    shards = max(1, -(-held.count() // SHARD))
    asked = materialise(_valid(queries), "queries")
    blocks = max(1, -(-asked.count() // QUERIES))
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    theirs = held.withColumns({"shard": hashed, "asks": F.lit(False)})
    theirs = theirs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    ours = asked.withColumns({"block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"), "asks": F.lit(True)})
    none = F.lit(None).cast("long")
    first = ours.withColumns({"shard": F.lit(0), "floor": none})
    found = materialise(_search(theirs.filter("shard = 0"), first, k), "first-shard")
    if shards > 1:
        # A query that k of the first shard answer with a score can't have a k-th best below it.
        # Rows that share an id share answers: the floor holds for the least of them.
        ends = found.groupBy(F.col("query_id").alias("vec_id")).agg(
            F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")
        )
        copies = asked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("copies"))
        safe = ends.join(copies, "vec_id").filter((F.col("copies") == 1) & (F.col("n") >= k)).select("vec_id", "floor")
        rest = ours.join(safe, "vec_id", "left")
        rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
        found = found.unionByName(_search(theirs.filter("shard > 0"), rest, k))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _valid(vectors: DataFrame) -> DataFrame:
    kept = doubles(vectors).filter(finite() & F.col("vec_id").isNotNull())
    return kept.select("vec_id", "embedding", F.size("embedding").alias("dim"))
