"""Importance resampling, against plain loops and zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tallyhall.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, runs=1):
    words = WORD.findall((text or "").translate(UPPER))
    return [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, buckets=resample.BUCKETS, runs=1):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in plain_features(t, runs))
    t = Counter(bucket(f) for x in target for f in plain_features(x, runs))
    size_s, size_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for doc, text in docs:
        found = plain_features(text, runs)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * size_s / ((s[b] + 1) * size_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(plain_features(text))])
    drawn = sorted((r for r in rows if r[5] >= resample.MIN_WORDS), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(drawn[: len(drawn) * resample.PERCENT // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_crc_by_place_equals_zlib():
    draw = random.Random(1)
    data = np.frombuffer(draw.randbytes(9000), np.uint8)
    sizes = [*range(0, 200), 255, 256, 257, 1000, 8999]
    starts = np.array([draw.randrange(0, 9000 - n) for n in sizes])
    ends = starts + np.array(sizes)
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert resample.PlaceTable().crc(data, starts, ends).tolist() == want


def test_features_of_several_words():
    texts = ["One two  THREE,four", "", "É ß 5x", "a", "b c " + "long" * 100 + " d"]
    crcs, of, n_words = resample.features(pa.array(texts), 3)
    got = Counter(zip(of.tolist(), crcs.tolist()))
    assert got == Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in plain_features(t, 3))
    assert n_words.tolist() == [4, 0, 3, 1, 4]


def corpus():
    draw = random.Random(2)
    vocabulary = [f"wort{i}" for i in range(300)] + ["Été", "x" * 200, "ÀB"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    docs = [(i, text(draw.choice([0, 5, 19, 20, 21, 60, 300]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "\u0000;:"), (203, "Z" * 70_000), (None, text(30)), (None, text(30))]
    docs += [(204, text(40))] * 3 + [(205, text(50_000))]
    return docs, [text(30) for _ in range(10)] + [None, ""]


def test_as_plain_loops(spark):
    docs, target = corpus()
    for runs in (1, 2):
        df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id int, text string, weight int").repartition(6)
        want = spark.createDataFrame([(t,) for t in target], "text string")
        got = resample.resample(df, want, runs=runs).collect()
        assert sorted((tuple(r) for r in got), key=str) == plain(docs, target, runs=runs)


def test_drawn_rows_and_no_rows(spark):
    docs, target = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = spark.createDataFrame([(t,) for t in target], "text string")
    ranks = sorted(r["rank"] for r in resample.sample(df, want, percent=50).collect())
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 20
    assert resample.resample(df.filter("false"), want).count() == 0
    assert resample.resample(df, want.filter("false")).count() == len(docs)
