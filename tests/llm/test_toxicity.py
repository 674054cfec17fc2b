"""The classifier: features, training, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tallyhall.llm import toxicity

BAD = ["vile", "scummy", "rotten"]


def corpus(n=900):
    draw = random.Random(11)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(n):
        text = draw.choices(words, k=draw.randint(5, 60))
        toxic = int(draw.random() < 0.25)
        if toxic:
            text.insert(draw.randint(0, len(text)), draw.choice(BAD))
        rows.append((i, " ".join(text), toxic))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs.withColumns({"score": F.lit("clash"), "predicted": F.lit(1)}), labels.withColumn("text", F.lit("x"))


def test_held_out_accuracy(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    model = toxicity.fit(docs, labels)
    assert 0 < len(model.slots) < 5000  # most weights are zero
    got = {r.doc_id: r for r in toxicity.digest(docs, model).collect()}
    assert len(got) == len(rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    held = [(y, got[i].predicted) for i, _, y in rows if got[i].held_out]
    assert np.mean([y == p for y, p in held]) > 0.95
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(300)
    docs, labels = frames(spark, rows)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert one.bias == two.bias and (one.weights == two.weights).all()


def test_odd_rows(spark):
    docs, labels = frames(spark, corpus(200))
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "word1 vile"), (2, "word2 " * 60000 + "vile")], "doc_id long, text string")
    got = {(r.doc_id, r.score) for r in toxicity.digest(odd, model).collect()}
    base = 1 / (1 + np.exp(-model.bias))
    assert sum(abs(s - base) < 1e-12 for _, s in got) >= 1 and len(toxicity.digest(odd, model).collect()) == 4
    kept = toxicity.keep_clean(odd.withColumn("lang", F.lit("en")), model)
    assert kept.columns == ["doc_id", "text", "lang"]
    assert toxicity.digest(odd.limit(0), model).count() == 0


def test_no_labels(spark):
    docs, labels = frames(spark, corpus(20))
    for none in (labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.withColumn("toxic", F.lit(7))):
        model = toxicity.fit(docs, none)
        assert len(model.slots) == 0
        assert {r.predicted for r in toxicity.digest(docs, model).collect()} == {0}


def test_ftrl_by_hand():
    """One row, one feature: the closed form of the first update."""
    rows, labels = [np.array([3], np.int32)] * 40, [1] * 40
    model = toxicity.ftrl(rows + [np.array([4], np.int32)] * 40, labels + [0] * 40)
    weight = dict(zip(model.slots.tolist(), model.weights))
    assert weight.get(3, 0) >= 0 >= weight.get(4, 0)


def test_features_see_order():
    use = toxicity.Hasher()
    one, two = set(use.features("a b c").tolist()), set(use.features("c b a").tolist())
    assert len(one & two) == 3 and len(one) == 6
    assert use.features("").size == 0 and use.features("a").size == 1
