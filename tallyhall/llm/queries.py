"""The operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhall.llm import (
    chat,
    count_min,
    cover_tree,
    html_text,
    order_minhash,
    packing,
    pieces,
    resample,
    secret_scan,
    token_files,
    topk,
    toxicity,
    treap,
)
from tallyhall.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query
def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf, "documents"), path)
    return token_files.digest(token_files.read(spark, path))


@query
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf, "documents")))


@query
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.digest(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op10_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf, "documents"))


@query
def op3_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return cover_tree.link_table(table(spark, sf, "embeddings"))


@query
def op4_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op5_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@query
def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.digest(pieces.decode(pieces.encode(table(spark, sf, "documents"))))


@query
def op6_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"  # the contract's conversation of control strings
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], columns)
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(turns.unionByName(extra)))


@query
def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return count_min.digest(count_min.without_repeats(table(spark, sf, "documents")))


@query
def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return treap.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
