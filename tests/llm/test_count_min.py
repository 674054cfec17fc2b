"""Passages that repeat, against a plain count of all windows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyhall.llm import count_min

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, width):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def corpus():
    draw = random.Random(3)
    fresh = lambda n: [f"w{draw.randrange(5000)}é" for _ in range(n)]
    passage, short = fresh(60), fresh(34)
    texts = [" ".join(fresh(draw.randrange(0, 120))) for _ in range(60)]
    texts += ["\t".join(fresh(20) + passage + fresh(30)), " \n".join(passage + fresh(5)), " ".join(fresh(9) + short)]
    texts += [" ".join(short), " ".join(fresh(35))] + [" ".join(passage[:35])] * 2
    texts += ["la " * 500, " ".join(fresh(50) + passage + passage), "", None, "  \n", "x" * 100_000]
    texts += [" ".join(fresh(80)), "a b " * 18, "x\u0000y " * 40, " ".join(fresh(20_000) + passage)]
    return texts


def found(spark, texts, width=count_min.WIDTH):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, kept string").repartition(5)
    got = {r.doc_id: r for r in count_min.without_repeats(df, width).collect()}
    return [got[i] for i in range(len(texts))]


def test_as_a_plain_count_finds_them(spark):
    texts = corpus()
    for width in (35, 4):
        rows = found(spark, texts, width)
        assert [(r.n_words, r.n_removed, r.kept) for r in rows] == plain(texts, width)
        for r in rows:
            assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed


def test_a_tiny_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(count_min, "MAX_CELLS", 1 << 11)
    monkeypatch.setattr(count_min, "GROUP", 100)
    monkeypatch.setattr(count_min, "CHUNK_WINDOWS", 50)
    texts = corpus()
    assert [(r.n_words, r.n_removed, r.kept) for r in found(spark, texts)] == plain(texts, 35)


def test_estimates_never_fall_below_counts():
    texts = [t or "" for t in corpus()]
    windows = count_min.Windows(pa.array(texts), 35)
    count = Counter(windows.anchors().tolist())
    words = [WORD.findall(t) for t in texts]
    true = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    flat = [w for ws in words for w in ws]
    for i in range(len(windows.whole)):
        if windows.whole[i]:
            assert count[int(windows.anchor_of(np.array([i]))[0])] >= true[tuple(flat[i : i + 35])] >= 1
    assert len(windows.anchors()) < 0.15 * windows.whole.sum() + 600


def test_null_and_repeated_ids_and_no_rows(spark):
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(None, text), (None, None), (7, "other " + text), (7, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = count_min.digest(count_min.without_repeats(df)).select("doc_id", "n_words", "n_removed")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 40, 40), (None, 0, 0), (7, 41, 40), (7, 2, 0)], key=str)
    assert count_min.without_repeats(df.filter("false")).count() == 0
    assert count_min.without_repeats(df.filter("text is null")).select(F.sum("n_removed")).first()[0] == 0
