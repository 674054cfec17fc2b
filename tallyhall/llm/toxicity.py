"""Toxicity scores by FTRL-proximal logistic regression over hashed words, pairs and skips.

Features of a text, each counted once: its words, neighbouring pairs, and pairs with one
word between, hashed into :data:`SLOTS` slots. Training goes through a bounded sample of
labelled rows one by one, with a rate for each coordinate; the L1 term keeps most weights
at exactly zero, so the model is a short list that every task gets.

The sample is the SAMPLE_ROWS labelled rows with the smallest hashes of ``doc_id`` and
stops at SAMPLE_FEATURES features. Rows without a label of 0 or 1, with a null id or with
no document are not learned from; a document with several labels counts as toxic if any
says so. Null and empty texts have no features and score as the base rate. Without any
labelled rows that rate is :data:`PRIOR`. Repeated rows are scored one by one; further
columns are kept; empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhall.llm.common import fresh, process_state, slices, small_batches, smallest

SLOTS_BITS = 22
SLOTS = 1 << SLOTS_BITS
SAMPLE_ROWS = 16_000
SAMPLE_FEATURES = 40_000_000
UPDATES = 30_000  # small samples are gone through more often, up to 20 times; all at least 3 times
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
PRIOR = 0.1
REJECT = 0.3
MAX_WORDS = 250_000  # words whose hashes a worker remembers
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Base log-odds and the weights that are not zero."""

    bias: float
    slots: np.ndarray
    weights: np.ndarray


class Hasher:
    """Slots of a text's features; remembers the hashes of words."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}

    def word(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        return (zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF

    def features(self, text: str) -> np.ndarray:
        found, known = WORD.findall(text.lower()), self.words
        try:
            hashes = [known[w] for w in found]
        except KeyError:
            if len(known) > MAX_WORDS:
                known.clear()
            for w in found:
                if w not in known:
                    known[w] = self.word(w)
            hashes = [known[w] for w in found]
        one = np.array(hashes, dtype=np.uint64)
        mix = np.uint64(0xC2B2AE3D27D4EB4F)
        turned = one * mix
        pairs = (turned[:-1] ^ (one[1:] >> np.uint64(7))) * mix
        skips = (turned[:-2] ^ (one[2:] >> np.uint64(11))) * np.uint64(0x165667B19E3779F9)
        return (np.concatenate([one, pairs, skips]) >> np.uint64(64 - SLOTS_BITS)).astype(np.int32)


def hasher() -> Hasher:
    return process_state("toxicity-words", Hasher, large=True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id's text, modulo 4, is 2."""
    checksum = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary"))
    return F.coalesce(F.pmod(checksum, F.lit(4)) == 2, F.lit(False))


def ftrl(rows: list[np.ndarray], labels: list[int]) -> Model:
    """FTRL-proximal over distinct slots of each row; the bias is fitted without penalty."""
    positive = sum(labels)
    bias_start = np.log((positive + PRIOR) / (len(labels) - positive + 1 - PRIOR))
    z, n = np.zeros(SLOTS, np.float64), np.zeros(SLOTS, np.float64)
    bias, bias_n = float(bias_start), 0.0

    def weight(at: np.ndarray, z_at: np.ndarray, n_at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z_at) * L1 - z_at
        return np.where(np.abs(z_at) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n_at)) / ALPHA + L2))

    for _ in range(max(3, min(20, -(-UPDATES // max(1, len(rows)))))):
        for at, label in zip(rows, labels):
            z_at, n_at = z[at], n[at]
            w = weight(at, z_at, n_at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - label
            square = gradient * gradient
            root = np.sqrt(n_at)
            z[at] = z_at + gradient - (np.sqrt(n_at + square) - root) / ALPHA * w
            n[at] = n_at + square
            bias_n += square
            bias -= ALPHA * gradient / (BETA + np.sqrt(bias_n))
    slots = np.flatnonzero(np.abs(z) > L1)
    return Model(float(bias), slots, weight(slots, z[slots], n[slots]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of the rows not held out; one task learns it.

    Only labels and ids are sorted to find the sample; its texts become features in
    parallel and reach the learning task as slots.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_y"))
        .filter("_id is not null and _y in (0, 1)")
        .filter(~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    wanted = smallest(usable, F.xxhash64("_id"), SAMPLE_ROWS, usable.count())
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(wanted), "_id")  # at most SAMPLE_ROWS rows of two numbers

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hasher()
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [np.unique(known.features(t or "")).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.record_batch({"_id": batch.column("_id"), "_y": batch.column("_y"), "_f": pa.array(found, pa.binary())})

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, size = [], [], 0
        for batch in batches:
            for label, data in zip(batch.column("_y").to_pylist(), batch.column("_f").to_pylist()):
                size += len(data) // 4
                if size <= SAMPLE_FEATURES and len(rows) < SAMPLE_ROWS:
                    rows.append(np.frombuffer(data, np.int32))
                    labels.append(label)
        model = ftrl(rows, labels)
        yield pa.record_batch(
            {
                "bias": pa.array([model.bias]),
                "slots": pa.array([model.slots.astype("<i4").tobytes()], pa.binary()),
                "weights": pa.array([model.weights.astype("<f8").tobytes()], pa.binary()),
            }
        )

    slots = small_batches(sample).mapInArrow(features, "_id long, _y int, _f binary")
    order = [F.xxhash64("_id"), F.col("_id"), F.col("_f")]  # ids may repeat in docs
    one = slots.repartition(1).sortWithinPartitions(*order)
    learned = one.mapInArrow(learn, "bias double, slots binary, weights binary").collect()
    if not learned:  # no task had a row
        return ftrl([], [])
    row = learned[0]
    return Model(row["bias"], np.frombuffer(row["slots"], "<i4"), np.frombuffer(row["weights"], "<f8"))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The rows with a score between 0 and 1 of their whole texts, as a last column."""
    rest = [c for c in docs.columns if c != column]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField(column, T.DoubleType())])

    def dense() -> np.ndarray:
        weights = np.zeros(SLOTS, np.float32)
        weights[model.slots] = model.weights
        return weights

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = hasher(), dense()
        for whole in batches:
            for batch in slices(whole, "text"):
                scores = []
                for text in batch.column("text").to_pylist():
                    slots = known.features(text or "")
                    active = np.unique(slots[weights[slots] != 0])
                    odds = model.bias + float(weights[active].sum(dtype=np.float64))
                    scores.append(1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, odds)))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column]
                )

    return small_batches(docs.select(*rest)).mapInArrow(rate, schema)


def digest(docs: DataFrame, model: Model) -> DataFrame:
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with their own columns."""
    column = fresh(docs, "_score")
    return score(docs, model, column).filter(F.col(column) < REJECT).select(*docs.columns)
