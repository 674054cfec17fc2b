"""Token ids in files: one zstandard frame for each document, a shared dictionary, an offset index.

A folder written by :func:`write` holds three Parquet tables, so Spark's commit protocol
makes a file of a lost task vanish and any store Spark can reach will do:

* ``dictionary``: one row ``(hash, width, data)``; ``width`` is the bytes of one id
* ``shards``: one row for each run of documents in ascending ``doc_id`` order, with
  ``part, shard, first_doc, last_doc, before`` (ids of the part before this shard),
  ``n_docs, n_tokens, dict_hash, index, payload``
* ``parts``: ids before each part

``payload`` is the frames, one after the other; ``index`` one record (:data:`RECORD`) for
each: document, tokens, offset in the payload, bytes. A reader of one document reads the
shards whose range holds it (pushed to the scan), then one slice, then one small frame.

Null ``doc_id`` comes first and is kept as null; a null text is empty and yields the end
id alone; repeated ids are documents of their own, in the order of the checksums of their
ids; an empty table gives empty files. The folder ``frames`` is left over from writing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import process_state, rows, slices, small_batches, smallest, text_or_empty
from tallyhall.llm.tokens import END, tokenizer_json, word_encoder

RECORD = np.dtype([("doc", "<i8"), ("null", "u1"), ("tokens", "<u4"), ("offset", "<u8"), ("bytes", "<u4")])
SHARD_TOKENS = 1 << 20
SHARD_DOCS = 1 << 16
SAMPLE_DOCS = 1500  # texts the dictionary is trained on
SAMPLE_CHARS = 4000  # of each of them at most
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

SHARDS = (
    "part int, shard int, first_doc long, last_doc long, before long, n_docs long, n_tokens long, "
    "dict_hash long, index binary, payload binary"
)
SHARD_SCHEMA = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32())]
    + [(n, pa.int64()) for n in ("first_doc", "last_doc", "before", "n_docs", "n_tokens", "dict_hash")]
    + [("index", pa.binary()), ("payload", pa.binary())]
)
IDS = "doc_id long, start long, n_tokens long, ids binary"


def narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widen(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(texts: list[str], spec: str, width: int) -> bytes:
    """A zstandard dictionary over serialized ids, empty if there is too little to learn from."""
    samples = [narrow(ids, width) for ids in word_encoder(spec).encode(texts) if ids]
    if len(samples) < 32 or sum(map(len, samples)) < 8 * DICTIONARY_BYTES // 4:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too few for the trainer
        return b""


def _coder(data: bytes, kind: str):
    def make():
        use = zstandard.ZstdCompressionDict(data) if data else None
        if kind == "write":
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=use)
        return zstandard.ZstdDecompressor(dict_data=use)

    return process_state(f"zstd-{kind}-{zlib.crc32(data)}-{len(data)}", make)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END) -> None:
    """Encodes every text and writes the files under ``path``.

    Texts are encoded and compressed where they lie; the frames, a fraction of their size, are
    stored and then sorted by ranges of ``doc_id``. Rows of one id come in the order of a hash
    of their ids, which is also the last range column: an id that many rows share is cut over
    several shards' tasks. The dictionary is trained on SAMPLE_DOCS texts with the smallest
    hashes; it decides sizes, not content.
    """
    spark, spec = docs.sparkSession, tokenizer_json(tokenizer)
    width = 2 if word_encoder(spec).width <= 1 << 16 else 4
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())
    filled = texts.filter("text <> ''")
    sample = smallest(filled, F.xxhash64("doc_id", "text"), SAMPLE_DOCS, docs.count())
    sample = sample.select(F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    data = train_dictionary([r.text for r in sample.collect()], spec, width)
    stamp = zlib.crc32(data)
    spark.createDataFrame([(stamp, width, data)], "hash long, width int, data binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, coder = word_encoder(spec), _coder(data, "write")
        tail = np.array([end], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = [body + tail for body in encoder.encode(batch.column("text").to_pylist())]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id"),
                        "tokens": pa.array([len(body) // 4 for body in ids], pa.int64()),
                        "mark": pa.array([zlib.crc32(body) for body in ids], pa.int64()),
                        "frame": pa.array([coder.compress(narrow(body, width)) for body in ids], pa.binary()),
                    }
                )

    frames = small_batches(texts).mapInArrow(encode, "doc_id long, tokens long, mark long, frame binary")
    frames = _stored(frames, f"{path}/frames")
    _pack(frames, stamp).write.option("compression", "none").parquet(f"{path}/shards")
    totals = spark.read.schema(SHARDS).parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    starts = totals.select("part", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("part_start"))
    starts.coalesce(1).write.parquet(f"{path}/parts")


def _stored(frames: DataFrame, path: str) -> DataFrame:
    frames.write.option("compression", "none").parquet(path)  # compressed as they are
    return frames.sparkSession.read.schema(frames.schema).parquet(path)


def _pack(frames: DataFrame, stamp: int) -> DataFrame:
    """Frames in ascending order of ``doc_id``, nulls first, as shards with their offset index."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        index: list[np.ndarray] = []
        payload: list[bytes] = []
        tokens = docs = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal index, payload, tokens, docs, size, shard, before
            all_ = np.concatenate(index)
            known = all_["doc"][all_["null"] == 0]
            made = rows(
                SHARD_SCHEMA,
                part=[part],
                shard=[shard],
                first_doc=[int(known[0]) if len(known) else None],
                last_doc=[int(known[-1]) if len(known) else None],
                before=[before],
                n_docs=[docs],
                n_tokens=[tokens],
                dict_hash=[stamp],
                index=[all_.tobytes()],
                payload=[b"".join(payload)],
            )
            before, shard = before + tokens, shard + 1
            index, payload, tokens, docs, size = [], [], 0, 0, 0
            return made

        for batch in batches:
            count = batch.column("tokens").to_numpy()
            frame = batch.column("frame")
            length = pa.compute.binary_length(frame).to_numpy().astype(np.int64)
            ids = batch.column("doc_id")
            record = np.zeros(batch.num_rows, RECORD)
            record["doc"], record["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            record["tokens"], record["bytes"] = count, length
            start = 0
            while start < batch.num_rows:  # a shard ends with the document that fills it
                full = np.searchsorted(np.cumsum(count[start:]), SHARD_TOKENS - tokens) + 1
                end = min(batch.num_rows, start + int(full), start + SHARD_DOCS - docs)
                own = record[start:end].copy()
                own["offset"] = size + np.cumsum(length[start:end]) - length[start:end]
                index.append(own)
                payload.extend(frame.slice(start, end - start).to_pylist())
                size, tokens, docs = size + int(length[start:end].sum()), tokens + int(count[start:end].sum()), docs + end - start
                start = end
                if tokens >= SHARD_TOKENS or docs >= SHARD_DOCS:
                    yield flush()
        if docs:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc(), F.xxhash64("frame").asc()]
    return frames.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, SHARDS)


def _shards(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, int, int]:
    found = spark.read.parquet(f"{path}/dictionary").first()
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards").join(parts, "part")
    return shards, bytes(found["data"]), found["width"], found["hash"]


def _frames(data: bytes, width: int, stamp: int, wanted: frozenset | None = None):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        coder = _coder(data, "read")
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: batch.column(n)[row] for n in ("dict_hash", "index", "payload", "before", "part_start")}
                if get["dict_hash"].as_py() != stamp or zlib.crc32(data) != stamp:
                    raise ValueError("these shards were written with another dictionary")
                index = np.frombuffer(get["index"].as_py(), RECORD)
                first = get["part_start"].as_py() + get["before"].as_py()
                start = first + np.concatenate([[0], np.cumsum(index["tokens"], dtype=np.int64)[:-1]])
                payload, picked = get["payload"].as_buffer(), np.arange(len(index))
                if wanted is not None:
                    picked = np.flatnonzero(np.isin(index["doc"], list(wanted)) & (index["null"] == 0))
                for i in range(0, len(picked), 4096):
                    part = picked[i : i + 4096]
                    at = index[part]
                    ids = [
                        widen(coder.decompress(payload[int(o) : int(o) + int(n)]), width)
                        for o, n in zip(at["offset"], at["bytes"])
                    ]
                    docs = [None if null else int(d) for d, null in zip(at["doc"], at["null"])]
                    yield rows(
                        schema, doc_id=docs, start=start[part], n_tokens=at["tokens"].astype("int64"), ids=ids
                    )

    return decode


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids`` (little-endian 32-bit)."""
    shards, *coding = _shards(spark, path)
    return shards.mapInArrow(_frames(*coding), IDS)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents of a short list, read by way of the ranges and the offset index."""
    shards, *coding = _shards(spark, path)
    holds = F.lit(False)
    for doc in doc_ids:
        holds = holds | ((F.col("first_doc") <= doc) & (F.col("last_doc") >= doc))
    return shards.filter(holds).mapInArrow(_frames(*coding, wanted=frozenset(doc_ids)), IDS)


def digest(ids: DataFrame) -> DataFrame:
    """Each document's place, length and unsigned checksum of its 32-bit ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
