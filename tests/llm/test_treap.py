"""Ranked search, against plain sums over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyhall.llm import treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    split = lambda t: TERM.findall((t or "").translate(UPPER))
    found = [(i, split(t)) for i, t in docs]
    N, L = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    counts = [(i, len(t), Counter(t)) for i, t in found]
    df = Counter(x for _, _, c in counts for x in c)
    out = []
    for item, text in items:
        asked, scored = set(split(text)), []
        for doc, n, c in counts:
            score = 0
            for t in asked & set(c):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * N // L)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus():
    draw = random.Random(4)
    vocabulary = [f"Term{i}" for i in range(120)] + ["ÉTÉ", "été", "x" * 90]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: "; ".join(draw.choices(vocabulary, weights, k=n))
    docs = [(i, text(draw.choice([0, 1, 3, 20, 80]))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "nothing asked"), (503, text(30_000)), (None, text(20)), (None, text(20))]
    docs += [(504, "term5 term9")] * 70
    items = [(i, text(12)) for i in range(12)] + [(50, None), (51, "unknown words"), (52, " ".join(vocabulary)), (None, "term7")]
    return docs, items


@pytest.mark.parametrize("shard,opened,pending", [(1 << 15, 1 << 14, 1 << 24), (32, 8, 64), (7, 1, 1)])
def test_as_plain_sums(spark, monkeypatch, shard, opened, pending):
    for name, value in (("MAX_DOCS", shard), ("OPENED", opened), ("PENDING", pending)):
        monkeypatch.setattr(treap, name, value)
    docs, items = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id int, text string, score int").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for k in (50, 3):
        got = [tuple(r) for r in treap.search(df, asked, k).collect()]
        assert sorted(got, key=str) == plain(docs, items, k)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(treap, "MAX_TERMS", 15)
    docs, items = corpus()
    df = spark.createDataFrame(docs[:60], "doc_id long, text string")
    got = [tuple(r) for r in treap.search(df, spark.createDataFrame(items[:4], "item_id long, text string")).collect()]
    assert sorted(got, key=str) == plain(docs[:60], items[:4], 50)


def test_no_rows(spark):
    docs, items = corpus()
    df = spark.createDataFrame(docs[:9], "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert treap.search(df.filter("false"), asked).count() == 0
    assert treap.search(df, asked.filter("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert treap.search(df, asked.filter("text is null")).count() == 0


def test_paths_lead_to_every_cell():
    draw = np.random.default_rng(1)
    cells = np.unique(draw.integers(0, 37 * 50, 300))
    rows, columns = cells // 50, cells % 50
    scores = draw.integers(1, 99, len(cells))
    grid = treap.Treap(rows, columns, scores, 50)
    for row in range(37):
        own = rows == row
        got = grid.best(np.array([row]), 100, 1)
        assert sorted(zip(got[1].tolist(), got[0].tolist())) == sorted(zip(columns[own].tolist(), scores[own].tolist()))
