"""Importance resampling towards a target: hashed word runs, gains by bucket, a weighted draw.

Texts are lower-cased (A-Z only) and cut into words; features are all runs of one to
``runs`` consecutive words joined by one space. A feature's bucket is the CRC-32 of its
bytes modulo ``buckets``.

CRC by place: the CRC of a span is the XOR of one value for each of its bytes, which
depends on the byte and its distance from the end only, and of one for the length. The
values of the last :data:`BLOCK` places are a table, so all spans of a batch take one
look-up a byte and one ``bitwise_xor.reduceat``. Longer spans are folded block by block:
the CRC so far goes into the first four bytes of the next block.

Counts of both tables are sums over everything; the gains, one number a bucket, are
broadcast. Ranks come from a sort by range and the sizes of the parts before, never from
one task.

Null texts have no words; null ids count as the empty string in the draw and come last
among equal scores; repeated rows are drawn each on its own, with the same score; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import materialise, process_state, slices, small_batches, text_or_empty
from tallyhall.llm.spans import LETTERS, LOWER, find_words, flat

RUNS = 1  # words of the longest feature
BUCKETS = 10_000
PERCENT = 10  # of the eligible documents that are drawn
MIN_WORDS = 20  # words of an eligible document
SEED = 2024
BLOCK = 64  # places in the table


class PlaceTable:
    """CRC-32 of many spans of one array at once."""

    def __init__(self) -> None:
        step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        table = np.empty((BLOCK, 256), np.uint32)
        table[0] = step
        for d in range(1, BLOCK):  # a zero byte behind moves the register on by one
            table[d] = step[table[d - 1] & 0xFF] ^ (table[d - 1] >> np.uint32(8))
        self.table = table
        self.lengths = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)

    def block(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """XOR of the contributions of spans of 1 to BLOCK bytes, without the length constant."""
        sizes = ends - starts
        places = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(places[-1]) + np.repeat(starts - places[:-1], sizes)
        before_end = np.repeat(ends, sizes) - 1 - at
        return np.bitwise_xor.reduceat(self.table.ravel()[(before_end << 8) | data[at]], places[:-1])

    def crc(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of each span; of an empty one 0."""
        out = np.zeros(len(starts), np.uint32)
        sizes = ends - starts
        first = np.where(sizes > 0, (sizes - 1) % BLOCK + 1, 0)
        some = np.flatnonzero(sizes > 0)
        if not len(some):
            return out
        split = starts + first
        out[some] = self.block(data, starts[some], split[some]) ^ self.lengths[first[some]]
        some = some[split[some] < ends[some]]
        while len(some):
            begin = split[some]
            state = ~out[some]  # the register that the next block starts from
            moved = np.zeros(len(some), np.uint32)
            for byte in range(4):
                moved ^= self.table[BLOCK - 1 - byte][(state >> np.uint32(8 * byte)) & np.uint32(0xFF)]
            out[some] = ~(self.block(data, begin, begin + BLOCK) ^ moved)
            split[some] += BLOCK
            some = some[split[some] < ends[some]]
        return out


def place_table() -> PlaceTable:
    return process_state("crc-place-table", PlaceTable)


def features(column: pa.Array, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC of every feature of a batch, the text it is of, and words of each text."""
    data, places = flat(column)
    data = LOWER[data]
    starts, ends, text = find_words(LETTERS[data], places)
    n_words = np.bincount(text, minlength=len(column))
    crcs, of = [place_table().crc(data, starts, ends)], [text]
    if runs > 1 and len(starts):
        sizes = ends - starts  # words anew, with one space behind each, so that runs are spans
        packed = np.cumsum(sizes + 1) - sizes - 1
        spaced = np.full(int(packed[-1] + sizes[-1] + 1), 0x20, np.uint8)
        offset = np.repeat(packed - starts, sizes)
        inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        spaced[inside + offset] = data[inside]
        for n in range(2, runs + 1):
            whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :])
            last = whole + n - 1
            crcs.append(place_table().crc(spaced, packed[whole], packed[last] + sizes[last]))
            of.append(text[whole])
    return np.concatenate(crcs), np.concatenate(of), n_words


def bucket_counts(texts: DataFrame, buckets: int, runs: int, column: str = "text") -> DataFrame:
    """Features of a whole table in each bucket: ``bucket, n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                crcs = features(batch.column("text"), runs)[0]
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    found = small_batches(texts.select(text_or_empty(column).alias("text"))).mapInArrow(count, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: int = RUNS) -> np.ndarray:
    """Gain of each bucket, in thousandths of a nat: log share in the target over log share here."""
    counts = []
    for df in (docs, target):
        own = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, buckets, runs).collect():  # a number for each bucket
            own[r["bucket"]] = r["n"]
        counts.append(own.tolist())
    here, there = counts
    s, t = float(sum(here) + buckets), float(sum(there) + buckets)
    return np.array(
        [math.floor(1000 * math.log(((b + 1) * s) / ((a + 1) * t))) for a, b in zip(here, there)], np.int64
    )


SCORED = "row long, doc_id long, n_words long, n_features long, weight long"


def weigh(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """Words, features and sum of gains of every row; ``row`` numbers rows once written."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, values = TaskContext.get().partitionId() << 32, shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                crcs, of, n_words = features(batch.column("text"), runs)
                weight = np.zeros(batch.num_rows, np.int64)
                np.add.at(weight, of, values[crcs % np.uint32(len(values))])
                yield pa.record_batch(
                    {
                        "row": row + np.arange(batch.num_rows, dtype=np.int64),
                        "doc_id": batch.column("doc_id"),
                        "n_words": pa.array(n_words, pa.int64()),
                        "n_features": pa.array(np.bincount(of, minlength=batch.num_rows), pa.int64()),
                        "weight": weight,
                    }
                )
                row += batch.num_rows

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())
    return small_batches(texts).mapInArrow(score, SCORED)


def ranked(rows: DataFrame, draw: int) -> DataFrame:
    """The rows with ``rank`` 1, 2, 3 ... by descending score for the first ``draw``."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ordered.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", part int, place long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["part"] = pa.array(np.full(n, part), pa.int32())
            columns["place"] = pa.array(np.arange(place + 1, place + n + 1), pa.int64())
            place += n
            yield pa.record_batch(columns)

    placed = materialise(ordered.mapInArrow(number, schema), "drawn")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    before = sizes.select("part", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place")
    return placed.join(F.broadcast(before), "part").withColumn("rank", F.when(rank <= draw, rank))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    runs: int = RUNS,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; undrawn ones have no rank.

    The score adds Gumbel noise, fixed by seed and id, to the weight: the highest scores
    are a draw without replacement with chances in proportion to exp(weight / 1000).
    """
    scored = materialise(weigh(docs, gains(docs, target, buckets, runs), runs), "weights")
    id_text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(id_text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = scored.withColumn("score", F.col("weight") + noise)
    eligible = F.col("n_words") >= min_words
    draw = scored.filter(eligible).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    drawn = ranked(scored.filter(eligible).drop("n_words"), draw).select(*columns)
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest.select(*columns))


def sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``doc_id`` with their ranks, for joining with the documents."""
    return resample(docs, target, **options).filter("rank is not null")
