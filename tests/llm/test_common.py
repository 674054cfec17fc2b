"""Helpers the operators share."""

import pyarrow as pa
from pyspark.sql import functions as F
from tallyhall.llm import common


def test_slices_bound_the_bytes_and_lose_nothing():
    texts = ["x" * n for n in (0, 5, 300, 1, 0, 99, 101, 2)] + [None, "é" * 80]
    batch = pa.record_batch({"text": pa.array(texts), "i": pa.array(range(len(texts)))})
    parts = list(common.slices(batch, "text", limit=100))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(sum(len((t or "").encode()) for t in p.column("text").to_pylist()[1:]) <= 100 for p in parts)
    assert list(common.slices(batch.slice(0, 0), "text")) == []


def test_smallest_hashes(spark):
    df = spark.range(20000).withColumn("_hash", F.lit("clash"))
    for total in (20000, 40000):  # an estimate that is too high keeps fewer candidates
        got = common.smallest(df, F.xxhash64("id"), 500, total)
        assert got.columns == ["id", "_hash"]
        want = df.orderBy(F.xxhash64("id")).limit(500)
        rows = {r.id for r in got.collect()}
        assert rows <= {r.id for r in want.collect()} and len(rows) > 400
    assert common.smallest(df, F.xxhash64("id"), 50000, 20000).count() == 20000
    assert common.smallest(df.limit(0), F.xxhash64("id"), 10, 0).count() == 0


def test_one_large_state():
    made = []
    for key in ("test-a", "test-a", "test-b", "test-a"):
        common.process_state(key, lambda key=key: made.append(key) or key, large=True)
    assert made == ["test-a", "test-b", "test-a"]
    common.process_state("test-small", lambda: made.append("small") or 1)
    common.process_state("test-small", lambda: made.append("small") or 1)
    assert made[3:] == ["small"]


def test_arrow_batches_are_bounded_in_bytes(spark):
    """Few hundred long texts don't come as one batch: rows alone don't bound a task's memory."""
    long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def size(batches):
        for batch in batches:
            yield pa.record_batch({"size": pa.array([batch.nbytes], pa.int64())})

    sizes = [r.size for r in common.small_batches(long).mapInArrow(size, "size long").collect()]
    assert sum(sizes) >= 40_000_000 and max(sizes) <= 5 * common.BATCH_BYTES
