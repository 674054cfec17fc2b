"""Passages that repeat: a count-min prefilter, then exact groups of what it leaves.

A window is :data:`WIDTH` consecutive words of one text. Every word covered by a window
that also starts anywhere else, the same text included, is taken out.

First pass: each window is counted under its anchor, the smallest hash among its runs of
:data:`RUN` words. Equal windows have equal anchors in equal places, and neighbouring
windows mostly share one, so some tenth of the words is counted. Every partition
makes a sparse count-min sketch of its anchors (cells that saturate at two); the sketches
are sent in slices of the hash range and merged there, in a stream, into a bit for each
cell. An estimate is the least of :data:`ROWS` cells and never below the true count, so no
repeated window is lost. Only the merged bits are broadcast: eight cells for each anchor,
:data:`MAX_CELLS` at most; beyond that more windows pass for repeated, nothing else.

Second pass: windows estimated repeated are grouped exactly, by 96-bit hashes. A chunk
of texts sends each hash once, with whether it met it twice, so a passage that a third of
all texts share costs one hash a chunk. The answer goes back to the chunk's texts as bits.

Texts without such windows never move. Null texts have no words; null or repeated ids are
rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import BATCH_ROWS, materialise, process_state, slices, small_batches, text_or_empty
from tallyhall.llm.spans import SOLID, WORD_RADIX, find_words, flat, mixed, powers, span_hashes, word_hashes

WIDTH = 35
RUN = 16  # words of the runs that anchors are taken from
ROWS = 2  # independent rows of the sketch
SLICES = 256  # parts of the hash range in which sketches are merged
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 29  # cells of a row; at most 64 MB of bits each
CELLS_EACH = 8  # cells of a row for each anchor counted
GROUP = 1 << 20  # windows that one group of the second pass holds on average at most
CHUNK_WINDOWS, CHUNK_TEXTS, CHUNK_BYTES = 1 << 19, 4096, 8 << 20  # a chunk ends beyond one of them

FOUND = "doc_id long, n_words long, kept binary, chunk long, slice int, base int, one binary, two binary, twice binary"
FOUND_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("kept", pa.binary()), ("chunk", pa.int64())]
    + [("slice", pa.int32()), ("base", pa.int32())]
    + [(name, pa.binary()) for name in ("one", "two", "twice")]
)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``width`` neighbours, in steps of doubled reach."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[:-rest], values[rest:]) if rest else values


class Windows:
    """Words, windows and anchors of a batch of texts."""

    def __init__(self, column: pa.Array, width: int):
        data, places = flat(column)
        self.starts, self.ends, self.text = find_words(SOLID[data], places)
        self.n_words = np.bincount(self.text, minlength=len(column))
        self.words = word_hashes(data, self.starts, self.ends)
        run = min(RUN, width)
        n = len(self.words) - width + 1
        self.width, self.run = width, run
        self.whole = self.text[: max(0, n)] == self.text[width - 1 :]  # windows within one text
        if n > 0 and self.whole.any():
            at = np.arange(len(self.words) - run + 1)
            self.runs = span_hashes(self.words, at, at + run, WORD_RADIX) | np.uint64(1)
            self.least = sliding(self.runs, width - run + 1, np.minimum)
            self.least[~self.whole] = 0
        else:
            self.runs = self.least = np.empty(0, np.uint64)
            self.whole = np.empty(0, bool)

    def anchors(self) -> np.ndarray:
        """Hash at each place that is the anchor of some window, spread evenly again."""
        if not len(self.least):
            return self.least
        reach = self.width - self.run + 1
        none = np.zeros(reach - 1, np.uint64)
        highest = sliding(np.concatenate([none, self.least, none]), reach, np.maximum)
        return mixed(self.runs[highest == self.runs])

    def anchor_of(self, at: np.ndarray) -> np.ndarray:
        """Hash of the anchor of each window that starts at ``at``."""
        return mixed(self.least[at])

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits, as 64 and 32, for each window that starts at ``at``."""
        one = span_hashes(self.words, at, at + self.width, WORD_RADIX)
        up, down = powers(WORD_RADIX).upto(len(self.words) + 1)
        sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(mixed(self.words ^ np.uint64(0xA0761D6478BD642F)) * up[:-1], out=sums[1:])
        return one, (mixed((sums[at + self.width] - sums[at]) * down[at]) >> np.uint64(32)).astype(np.uint32)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once, in order, and whether it came twice or more."""
    ordered = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, int)
    return ordered[first], np.diff(np.append(first, len(ordered))) > 1


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each hash in a row of ``1 << bits`` cells; all rows agree in the slice."""
    below = bits - (SLICES.bit_length() - 1)
    slice_ = hashes >> np.uint64(64 - (SLICES.bit_length() - 1))
    inner = mixed(hashes + np.uint64(row * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - below)
    return ((slice_ << np.uint64(below)) | inner).astype(np.int64)


def partition_sketches(texts: DataFrame, width: int) -> DataFrame:
    """Sparse sketches ``slice, n, hashes, twice, windows`` of parts of every partition."""
    schema = pa.schema(
        [("slice", pa.int32()), ("n", pa.int64()), ("hashes", pa.binary()), ("twice", pa.binary()), ("windows", pa.int64())]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = windows = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, windows
            hashes, twice = distinct(np.concatenate(held))
            slice_ = (hashes >> np.uint64(64 - (SLICES.bit_length() - 1))).astype(np.int64)
            used = np.unique(slice_)
            at = np.searchsorted(slice_, np.append(used, SLICES))
            parts = list(zip(at[:-1], at[1:]))
            out = pa.record_batch(
                [
                    pa.array(used, pa.int32()),
                    pa.array([b - a for a, b in parts], pa.int64()),
                    pa.array([hashes[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([np.packbits(twice[a:b]).tobytes() for a, b in parts], pa.binary()),
                    pa.array([windows if i == 0 else 0 for i in range(len(parts))], pa.int64()),
                ],
                schema=schema,
            )
            held, size, windows = [], 0, 0
            return out

        for whole in batches:
            for batch in slices(whole, "text"):
                found = Windows(batch.column("text"), width)
                anchors = found.anchors()
                windows += int(found.whole.sum())
                if len(anchors):
                    held.append(anchors)
                    size += len(anchors)
                if size >= 1 << 20:
                    yield flush()
        if size:
            yield flush()

    return texts.select("text").mapInArrow(sketch, "slice int, n long, hashes binary, twice binary, windows long")


def merged(sketches: DataFrame, bits: int, tasks: int) -> list[np.ndarray]:
    """For each row of the sketch one bit a cell: whether it was counted twice or more."""
    below = bits - (SLICES.bit_length() - 1)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[tuple[int, int], np.ndarray] = {}
        more: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                slice_ = batch.column("slice")[i].as_py()
                hashes = np.frombuffer(batch.column("hashes")[i].as_buffer(), np.uint64)
                twice = np.unpackbits(np.frombuffer(batch.column("twice")[i].as_buffer(), np.uint8), count=len(hashes))
                for row in range(ROWS):
                    key = (slice_, row)
                    if key not in once:
                        once[key], more[key] = np.zeros(1 << below, bool), np.zeros(1 << below, bool)
                    cell, double = distinct(cells(hashes, row, bits) & ((1 << below) - 1))
                    more[key][cell[once[key][cell] | double]] = True
                    once[key][cell] = True
                    more[key][cells(hashes[twice == 1], row, bits) & ((1 << below) - 1)] = True
        if once:
            keys = list(once)
            yield pa.record_batch(
                {
                    "slice": pa.array([k[0] for k in keys], pa.int32()),
                    "row": pa.array([k[1] for k in keys], pa.int32()),
                    "bits": pa.array([np.packbits(more[k]).tobytes() for k in keys], pa.binary()),
                }
            )

    dealt = sketches.select("slice", "hashes", "twice").repartition(tasks, "slice")
    out = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(ROWS)]
    size = (1 << below) // 8
    for r in dealt.mapInArrow(merge, "slice int, row int, bits binary").collect():
        out[r["row"]][r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def repeated_cells(rows: list[np.ndarray], hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the estimate of each hash, the least of its cells, is two or more."""
    out = np.ones(len(hashes), bool)
    for row, data in enumerate(rows):
        left = np.flatnonzero(out)
        cell = cells(hashes[left], row, bits)
        out[left] = (data[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out


class Suspects:
    """Windows of a chunk of texts that the sketch takes for repeated."""

    def __init__(self, rows: list[np.ndarray], bits: int, width: int):
        self.rows, self.bits, self.width = rows, bits, width
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and suspected windows of each text of a batch."""
        found = Windows(column, self.width)
        valid = np.flatnonzero(found.whole)
        at = valid[repeated_cells(self.rows, found.anchor_of(valid), self.bits)] if len(valid) else valid
        first_word = np.concatenate([[0], np.cumsum(found.n_words)])
        cut = np.searchsorted(at, first_word)
        if len(at):
            text = np.searchsorted(cut, np.arange(len(at)), "right") - 1
            self.parts.append((*found.digests(at), at - first_word[text], np.diff(cut)))
        else:
            self.parts.append((*_NONE, at, np.diff(cut)))
        self.count += len(at)
        return found.n_words, np.diff(cut)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each digest once, in order, whether it came twice, and which one each window has."""
        one, two = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        order = np.lexsort((two, one))
        fresh = _changes(one[order], two[order])
        refs = np.empty(len(order), np.int64)
        refs[order] = np.cumsum(fresh) - 1
        tops = np.flatnonzero(fresh)
        return one[order][tops], two[order][tops], np.diff(np.append(tops, len(order))) > 1, refs


_NONE = (np.empty(0, np.uint64), np.empty(0, np.uint32))


def _changes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(one), bool)
    fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return fresh


def suspects(texts: DataFrame, sketch, bits: int, groups: int, width: int) -> DataFrame:
    """Second pass: texts without suspected windows are done; of others, the windows by hash.

    Rows with ``slice`` hold the distinct hashes of a chunk, rows with ``chunk`` alone a
    text of it, compressed.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId() << 32, 0
        now, held = Suspects(sketch.value, bits, width), [0, 0]
        pack = process_state("zstd-1", lambda: zstandard.ZstdCompressor(level=1))

        def flush() -> pa.RecordBatch:
            one, two, twice, _ = now.distinct()
            of = _group(one, groups)
            used = np.unique(of)
            ranges = list(zip(np.searchsorted(of, used), np.searchsorted(of, used, "right")))
            return _rows(
                chunk=np.full(len(used), part | seen),
                slice=used,
                base=[a for a, _ in ranges],
                one=[one[a:b].tobytes() for a, b in ranges],
                two=[two[a:b].tobytes() for a, b in ranges],
                twice=[np.packbits(twice[a:b]).tobytes() for a, b in ranges],
            )

        for whole in batches:
            for batch in slices(whole, "text"):
                n_words, windows = now.add(batch.column("text"))
                kept = [b" ".join(t.split()) for t in batch.column("text").cast(pa.binary()).to_pylist()]
                yield _rows(
                    doc_id=batch.column("doc_id"),
                    n_words=n_words,
                    kept=[pack.compress(k) if w else k for k, w in zip(kept, windows)],
                    chunk=pa.array(np.full(len(kept), part | seen), mask=windows == 0),
                )
                held = [held[0] + len(kept), held[1] + sum(map(len, kept))]
                if now.count >= CHUNK_WINDOWS or held[0] >= CHUNK_TEXTS or held[1] >= CHUNK_BYTES:
                    if now.count:
                        yield flush()
                    now, held, seen = Suspects(sketch.value, bits, width), [0, 0], seen + 1
        if now.count:
            yield flush()

    return small_batches(texts).mapInArrow(scan, FOUND)


def _group(one: np.ndarray, groups: int) -> np.ndarray:
    """Group of each digest; groups are ranges, so digests in order are in order of groups."""
    return ((one >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    made = [
        pa.nulls(n, f.type)
        if f.name not in columns
        else columns[f.name].cast(f.type)
        if isinstance(columns[f.name], pa.Array)
        else pa.array(columns[f.name], f.type)
        for f in FOUND_SCHEMA
    ]
    return pa.record_batch(made, schema=FOUND_SCHEMA)


def _exact(table: pa.Table) -> pa.Table:
    """Which hashes of a slice come twice or more, over all chunks: bits for each chunk."""
    ones = [np.frombuffer(x, np.uint64) for x in table.column("one").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(d)) for x, d in zip(table.column("twice").to_pylist(), ones)]
    one, double = np.concatenate(ones), np.concatenate(twice)
    two = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("two").to_pylist()])
    order = np.lexsort((two, one))
    fresh = _changes(one[order], two[order])
    count = np.add.reduceat(1 + double[order].astype(np.int64), np.flatnonzero(fresh))
    repeated = np.empty(len(order), bool)
    repeated[order] = (count > 1)[np.cumsum(fresh) - 1]
    cut = np.cumsum([len(d) for d in ones])[:-1]
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "base": table.column("base"),
            "n": pa.array([len(d) for d in ones], pa.int32()),
            "bits": pa.array([np.packbits(x).tobytes() for x in np.split(repeated, cut)], pa.binary()),
        }
    )


def _take_out(sketch, bits: int, width: int):
    """Takes the repeated windows out of a chunk's texts, found anew as the second pass found them."""

    def settle(texts: pa.Table, answers: pa.Table) -> pa.Table:
        bases, sizes = answers.column("base").to_pylist(), answers.column("n").to_pylist()
        repeated = np.zeros(max(b + n for b, n in zip(bases, sizes)), bool)
        for base, n, found in zip(bases, sizes, answers.column("bits").to_pylist()):
            repeated[base : base + n] = np.unpackbits(np.frombuffer(found, np.uint8), count=n)
        unpack = zstandard.ZstdDecompressor()
        kept = [unpack.decompress(x) for x in texts.column("kept").to_pylist()]
        now, n_words = Suspects(sketch.value, bits, width), []
        for i in range(0, len(kept), BATCH_ROWS):
            n_words += now.add(pa.array(kept[i : i + BATCH_ROWS], pa.large_binary()))[0].tolist()
        hit = repeated[now.distinct()[3]]
        places = np.concatenate([p[2] for p in now.parts])
        cut = np.concatenate([[0], np.cumsum(np.concatenate([p[3] for p in now.parts]))])
        out: dict[str, list] = {"kept": [], "n_removed": [], "spans": []}
        for i, (text, n) in enumerate(zip(kept, n_words)):
            at = places[cut[i] : cut[i + 1]][hit[cut[i] : cut[i + 1]]]
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + width, -1)
            gone = np.cumsum(edge[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            out["kept"].append(b" ".join(compress(text.split(b" "), (~gone).tolist())) if len(at) else text)
            out["n_removed"].append(int(gone.sum()))
            out["spans"].append(turns.tolist())
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_words": texts.column("n_words"),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "spans": pa.array(out["spans"], pa.list_(pa.int64())),
                "kept": pa.array(out["kept"], pa.binary()),
            }
        )

    return settle


OUT = "doc_id long, n_words long, n_removed long, spans array<long>, kept binary"


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every row's ``doc_id, n_words, n_removed, spans, kept``.

    ``spans`` are the places of the words taken out: start and end (exclusive) of each run,
    one after the other. ``kept`` is the other words, joined by one space.
    """
    spark = docs.sparkSession
    texts = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty()))
    sketches = materialise(partition_sketches(texts, width), "count-min")
    total = sketches.agg(F.sum("n").alias("n"), F.sum("windows").alias("w")).first()
    wanted = min(MAX_CELLS, max(MIN_CELLS, CELLS_EACH * (total["n"] or 0)))
    bits = max(SLICES.bit_length() + 2, (wanted - 1).bit_length())  # a byte of a slice at least
    tasks = max(1, min(SLICES, sketches.rdd.getNumPartitions()))
    sketch = spark.sparkContext.broadcast(merged(sketches, bits, tasks))
    found = materialise(suspects(texts, sketch, bits, 1 + (total["w"] or 0) // GROUP, width), "suspects")
    hashes = found.filter("slice is not null").select("chunk", "slice", "base", "one", "two", "twice")
    answers = hashes.groupBy("slice").applyInArrow(_exact, "chunk long, base int, n int, bits binary")
    open_ = found.filter("chunk is not null and slice is null").select("doc_id", "n_words", "kept", "chunk")
    settled = open_.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_take_out(sketch, bits, width), OUT)
    done = found.filter("chunk is null").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<long>").alias("spans"),
        "kept",
    )
    texts_out = done.unionByName(settled)
    return texts_out.withColumn("kept", F.col("kept").cast("string"))


def digest(found: DataFrame) -> DataFrame:
    """Each row's counts and the hash of the words that stay."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
