"""Stages of the pipeline against plain versions of what they decide."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tallyhall.llm import order_minhash, toxicity
from tallyhall.llm.secret_scan import scan
from tallyhall.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found = materialise(stage(spark, docs, SF), name)
        out.append((docs, found))
        docs = found
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns
    assert steps[-1][1].columns[:2] == ["doc_id", "piece"]


def test_toxic_documents_go(spark, steps):
    docs, kept = steps[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.digest(docs, toxicity.fit(docs, labels))
    assert ids(kept) == ids(scored.filter("predicted = 0"))


def test_one_of_each_class_stays(steps):
    docs, kept = steps[1]
    assert ids(kept) == ids(order_minhash.classes(docs).filter("doc_id = class_id"))


def test_no_secret_stays(steps):
    docs, kept = steps[2]
    assert ids(kept) == ids(docs)
    assert scan(kept).filter(F.size("spans") > 0).count() == 0
    assert kept.filter("n_chars <> char_length(text)").count() == 0
    clean = scan(docs).filter(F.size("spans") == 0).select("doc_id", "text")
    assert clean.join(kept.select("doc_id", "text"), ["doc_id", "text"], "left_anti").count() == 0


def test_all_that_is_left_is_packed(steps):
    docs, packed = steps[3]
    assert ids(packed.filter("piece = 0")) == ids(docs)


def test_odd_input(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    rows = [(1, None, None, None, None, "x"), (1, "", "en", None, 0, None), (None, "token=abcdefgh", "en", "s", 14, "y")]
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SF), "odd")
        assert docs.count() >= 0
