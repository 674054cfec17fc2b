"""Cover-tree links and exact top-k against all pairs."""

import math
from fractions import Fraction

import numpy as np
import pytest
from tallyhall.llm import cover_tree, topk

NAN = float("nan")


def plain_links(rows):
    good = [(i, v) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = [np.array(v) / max(map(abs, v)) for _, v in good]  # first, so squares stay finite
    unit = [u / np.linalg.norm(u) for u in unit]
    near = {(i, j) for i in range(len(good)) for j in range(len(good)) if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95}
    label = [i for i, _ in good]
    for _ in range(len(good)):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    links = [sum((i, j) in near for j in range(len(good))) for i in range(len(good))]
    out = [(g[0], n, c, g[0] == c) for g, n, c in zip(good, links, label)]
    bad = [i for i, v in rows if (i, v) not in good]
    return sorted([*out, *((i, 0, i, True) for i in bad)], key=str)


def vectors(seed, n, dim=6):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(12, dim))
    rows = [(i, (base[draw.integers(12)] * draw.uniform(0.1, 9) + draw.normal(size=dim) * 0.25).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(15)]
    return rows


ODD = [(900, None), (901, []), (902, [0.0] * 6), (903, [1.0, NAN, 0.0, 0.0, 0.0, 0.0]), (904, [1.0, None] + [0.0] * 4)]
ODD += [(905, [math.inf] * 6), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e300] * 6), (909, [1e-300] * 6)]


@pytest.mark.parametrize("block", [7, 4096])
def test_links(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    rows = vectors(2, 120) + ODD
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as cell", "3 as n")
    found = sorted((tuple(r) for r in cover_tree.link_table(df).collect()), key=str)
    assert found == plain_links(rows)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.link_table(none).count() == 0
    assert topk.top_k(none, none).count() == 0
    odd = spark.createDataFrame([(None, [1.0]), (1, None)], "vec_id long, embedding array<float>")
    assert cover_tree.link_table(odd).filter("n_links = 0").count() == 2


def test_tree_holds_points_within_radii():
    draw = np.random.default_rng(5)
    points = cover_tree.unit(draw.normal(size=(300, 3)))
    tree = cover_tree.Tree(points)
    held = tree.inside
    for depth in range(len(tree.levels) - 1, -1, -1):
        away = cover_tree.angles((points * points[tree.levels[depth]][held]).sum(1))
        assert (away <= tree.radii[depth][held] + 1e-7).all()
        held = tree.parents[depth][held]
    assert all(set(a) <= set(b) for a, b in zip(tree.levels, tree.levels[1:]))


def plain_top(rows, k):
    scaled = {}
    good = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, q in good:
        if i % 100 == 0:
            held = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
            all_ = [(-held(sum(a * b for a, b in zip(q, v))), j) for j, v in good if j != i and len(v) == len(q)]
            scaled[i] = [(j, -s) for s, j in sorted(all_)[:k]]
    return scaled


@pytest.mark.parametrize("shard", [40, 4096])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    rows = [(i * 25, v) for i, v in vectors(3, 200)] + ODD + [(0, [0.5] * 6)]
    rows = [r for r in rows if r[0] != 0 or r[1] != [0.5] * 6]  # ids are unique here; repeats below
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as shard", "2 as dim")
    found = {}
    for r in topk.top_k(df, df.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == plain_top(rows, 10)


def test_top_k_of_few_and_repeated(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.5, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (9, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, df.filter("vec_id = 100").limit(1)).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [7, 7, 9] and found[0].score == 1024 * 1024


@pytest.mark.parametrize("shard", [2, 4096])
def test_large_components_are_scored(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    rows = [(0, [1.0, 0.0]), (1, [200000.0, 0.0]), (2, [1.0, 1.0]), (100, [-3e8, 1e5]), (101, [1e300, -1e300]), (3, [131072.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in topk.top_k(df, df.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == plain_top(rows, 10)
    assert dict(found[0])[1] == 209_715_200_000


def shuffled(spark):
    """Bytes that all stages so far wrote for others to read."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = store.stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_blocks_are_not_copied_for_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 50)
    points = np.random.default_rng(4).normal(size=(1000, 64)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(points)] + [(1000, (points[3] * 1.5).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    before = shuffled(spark)
    assert cover_tree.link_table(df).filter("n_links = 1").count() == 2
    assert shuffled(spark) - before < 3 * points.nbytes  # some twenty times in pairs of blocks


@pytest.mark.parametrize("dim, spread", [(64, 0.02), (64, 0.04), (5, 0.2), (1, 1.0), (3, 0.001)])
def test_meets_finds_every_link(dim, spread):
    draw = np.random.default_rng(dim)
    base = draw.normal(size=(40, dim)) / math.sqrt(dim)
    x, y = (cover_tree.unit(base[draw.integers(40, size=n)] + draw.normal(size=(n, dim)) * spread) for n in (601, 300))
    found = list(cover_tree.meets(cover_tree.Tree(x), cover_tree.Tree(y), 0.95))
    pairs = [p for i, j in found for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(pairs) == len(set(pairs)) and set(pairs) == set(zip(*map(np.ndarray.tolist, np.nonzero(x @ y.T >= 0.95))))


def test_a_common_vector_leaves_a_task_once(spark):
    rows = [(i, [1.0, 2.0] if i % 10 else [float(i), 1.0]) for i in range(5000)] + [(-3, [1.0, 2.0]), (-3, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    sent = cover_tree.copies(df, {}, "<f8").filter("weight > 100").collect()
    assert len(sent) <= 4 and sum(r.weight for r in sent) == 4502
    zeros = spark.createDataFrame([(1, [0.0, 1.0]), (2, [-0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in cover_tree.link_table(zeros).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
