"""Helpers the operators share: tables, per-process state, batches, hashing."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.session import materialise, scratch_path  # noqa: F401

BATCH_BYTES = 4 << 20  # text handled at once inside a task
BATCH_ROWS = 512  # texts in one Arrow batch: ten thousand very long ones would fill an executor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def small_batches(df: DataFrame) -> DataFrame:
    """The table, with the session's Arrow batches bounded to BATCH_ROWS rows and some times BATCH_BYTES."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * BATCH_BYTES))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def process_state(key: str, make: Callable[[], object], large: bool = False) -> object:
    """State of this worker process that outlives a task, such as a loaded tokenizer.

    Functions reach a worker by value, so their own globals start afresh in each task. Of
    ``large`` states, those that remember words, a worker keeps the last used one only:
    workers live on through all stages of a job.
    """
    store = sys.modules.setdefault("_tallyhall_state", types.ModuleType("_tallyhall_state")).__dict__
    if large and store.get("_large") != key:
        store.pop(store.get("_large"), None)
        store["_large"] = key
    if key not in store:
        store[key] = make()
    return store[key]


def smallest(df: DataFrame, hash_: Column, count: int, total: int) -> DataFrame:
    """The ``count`` rows with the smallest 64-bit hashes, of ``total`` rows.

    Rows beyond twice the share are filtered out first, so all tasks together hand the
    driver about twice ``count`` rows, however many tasks there are.
    """
    share = min(1.0, 2 * count / max(1, total))
    bound = min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))
    name = fresh(df, "_hash")
    near = df.withColumn(name, hash_).filter(F.col(name) <= F.lit(bound))
    return near.orderBy(name).limit(count).drop(name)


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no part holds much more than ``limit`` bytes of one column."""
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // limit
    start = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
