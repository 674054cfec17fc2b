"""Best-fit packing of token pieces into sequences, by residuals that merge up a tree.

Each partition best-fits its own pieces and closes the bins that are nearly full. Bins
with room left become items of the next round, where fewer tasks best-fit them again, and
so on up a tree. A bin placed in another keeps its pieces together; offsets add up on the
way back down. Every task holds at most :data:`MAX_ITEMS` items.

Lengths outside 1..capacity raise; null doc_ids are documents like others; repeated rows
are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import materialise, slices, small_batches, text_or_empty
from tallyhall.llm.tokens import END, tokenizer_json, word_encoder

CAPACITY = 4096
SLACK = 4  # a bin with no more room than this is closed
FAN_IN = 8  # tasks whose open bins meet in one task of the next round
MAX_ITEMS = 1 << 18  # items a task packs at once
MIN_GAIN = 0.01  # where one task can't hold all open bins, rounds end below this share saved

PLACED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill int, open boolean"
)
MERGED = "bin long, parent long, shift long, fill int, open boolean, first boolean"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each size, its place there, and how full each bin is: best fit, largest first.

    Bins are kept by the room they have left. One bit for each amount of room says whether
    such a bin exists, so the tightest bin that fits is the lowest bit not below the size.
    """
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    fills: list[int] = []
    rooms = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins[item], places[item] = bin_, fills[bin_]
        fills[bin_] += size
        if room > size:
            by_room[room - size].append(bin_)
            rooms |= 1 << (room - size)
    return bins, places, np.array(fills, np.int64)


def bin_ids(round_: int, count: int, used: int) -> np.ndarray:
    """Ids no other task or round gives out; written once before anything reads them."""
    base = (round_ << 56) | (TaskContext.get().partitionId() << 32)
    return base + used + np.arange(count, dtype=np.int64)


def pieces_of(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Pieces of every document, best-fitted among those of their partition."""
    spec = tokenizer_json(tokenizer)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail, used = word_encoder(spec), np.array([END], "<u4").tobytes(), 0
        held: list[tuple] = []

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal used, held
            length = np.array([h[3] for h in held], np.int64)
            bins, places, fills = best_fit(length, capacity)
            names = bin_ids(1, len(fills), used)
            used += len(fills)
            yield pa.record_batch(
                {
                    "doc_id": pa.array([h[0] for h in held], pa.int64()),
                    "piece": pa.array([h[1] for h in held], pa.int32()),
                    "start": pa.array([h[2] for h in held], pa.int64()),
                    "length": length,
                    "ids_crc32": pa.array([h[4] for h in held], pa.int64()),
                    "bin": names[bins],
                    "offset": places,
                    "fill": fills[bins].astype("int32"),
                    "open": (fills < capacity - slack)[bins],
                }
            )
            held = []

        for whole in batches:
            for batch in slices(whole, "text"):
                encoded = encoder.encode(batch.column("text").to_pylist())
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                    ids += tail
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        held.append((doc, piece, start, len(part) // 4, zlib.crc32(part)))
                if len(held) >= MAX_ITEMS:
                    yield from pack()
        if held:
            yield from pack()

    return small_batches(texts).mapInArrow(local, PLACED)


def merge_round(open_bins: DataFrame, round_: int, capacity: int, slack: int) -> DataFrame:
    """Open bins ``(bin, fill)`` best-fitted as items among those of their partition."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, names, sizes = 0, [], []

        def pack() -> pa.RecordBatch:
            nonlocal used, names, sizes
            items, size = np.concatenate(names), np.concatenate(sizes).astype(np.int64)
            bins, places, fills = best_fit(size, capacity)
            parents = bin_ids(round_, len(fills), used)
            used, names, sizes = used + len(fills), [], []
            return pa.record_batch(
                {
                    "bin": items,
                    "parent": parents[bins],
                    "shift": places,
                    "fill": fills[bins].astype("int32"),
                    "open": (fills < capacity - slack)[bins],
                    "first": places == 0,
                }
            )

        for batch in batches:
            names.append(batch.column("bin").to_numpy())
            sizes.append(batch.column("fill").to_numpy())
            if sum(map(len, names)) >= MAX_ITEMS:
                yield pack()
        if names:
            yield pack()

    return open_bins.mapInArrow(merge, MERGED)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A round carries the bins that some other open bin still fits into. Rounds go on until
    one task has seen them all; only where there are more than a task may hold do they end
    with a round that merges almost none of them.
    """
    placed = materialise(pieces_of(docs, tokenizer, capacity, slack), "pack-pieces")
    open_bins = placed.filter("open and offset = 0").select("bin", "fill")
    tasks, round_ = open_bins.rdd.getNumPartitions(), 1
    levels: list[DataFrame] = []
    while True:
        least = open_bins.agg(F.min("fill")).first()[0] or 0
        open_bins = open_bins.filter(F.col("fill") <= capacity - least)
        count = open_bins.count()
        if count < 2:
            break
        round_ += 1
        tasks = max(1, -(-tasks // FAN_IN), -(-count // MAX_ITEMS))
        dealt = open_bins.repartition(tasks, F.xxhash64("bin", F.lit(round_)))
        merged = materialise(merge_round(dealt, round_, capacity, slack), "pack-round")
        levels.append(merged)
        open_bins = merged.filter("open and first").select(F.col("parent").alias("bin"), "fill")
        bins_now = merged.filter("first").count()
        if tasks == 1 or tasks == -(-count // MAX_ITEMS) and count - bins_now < MIN_GAIN * count:
            break
    if not levels:
        found = placed.withColumns({"sequence_id": F.col("bin")})
        return found.select(*OUT)
    way = levels[-1].select("bin", "parent", "shift")
    for level in reversed(levels[:-1]):
        up = way.select(F.col("bin").alias("_bin"), F.col("parent").alias("_up"), F.col("shift").alias("_more"))
        way = level.join(up, F.col("parent") == F.col("_bin"), "left").select(
            "bin",
            F.coalesce("_up", "parent").alias("parent"),
            (F.col("shift") + F.coalesce("_more", F.lit(0))).alias("shift"),
        )
    closed = placed.filter(~F.col("open")).withColumn("sequence_id", F.col("bin"))
    moved = placed.filter("open").join(way, "bin", "left")
    moved = moved.withColumns(
        {
            "sequence_id": F.coalesce("parent", "bin"),
            "offset": F.col("offset") + F.coalesce("shift", F.lit(0)),
        }
    )
    return closed.select(*OUT).unionByName(moved.select(*OUT))


OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
