"""A training corpus from raw documents: clean, distinct, free of secrets, packed.

Each stage works on all its predecessor kept and returns the columns of ``documents``; the
last returns the pieces of the packed sequences. Null ids and texts, repeated rows, empty
tables and further columns go through every stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.llm import order_minhash, packing, secret_scan, toxicity
from tallyhall.llm.common import materialise, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a classifier of the labelled ones rejects."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return order_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes secrets out of the texts; every document stays."""
    redacted = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    size = F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return redacted.withColumn("n_chars", size)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("best_fit_packing", best_fit_packing),
]

#: No twin: a trained classifier and sketches have no SQL. tests/llm holds every stage
#: against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
