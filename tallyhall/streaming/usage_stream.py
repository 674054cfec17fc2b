"""Daily totals and keyed merges over a stream of landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

EVERY = 50  # micro-batches between compactions


def event_stream(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    """Files of ``folder`` that match ``pattern``, as they land."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def daily_usage(
    events: DataFrame, ts: str, keys: list[str], measure: str, lateness: str = "1 day"
) -> DataFrame:
    """Running totals per key and day. Rows later than ``lateness`` are dropped, as
    their day is final once the watermark has passed it."""
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 day").alias("w"), *keys)
        .agg(F.sum(measure).alias(measure))
        .select(*keys, F.to_date("w.start").alias("usage_date"), measure)
    )


def _run(stream: DataFrame, write, path: str, mode: str) -> None:
    """Process everything available now, one call of ``write`` for each micro-batch."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _folders(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished folders ``kind=<number>``, in order; one listing."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
    found = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
    done = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={n}/_SUCCESS"))
    while found and not done(found[-1]):  # only the last can be left half written
        found.pop()
    return found


def stored(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """Rows of the last compaction and of the micro-batches after it, with the ``batch`` that wrote them.

    Only those folders are opened: at most EVERY of micro-batches. With ``before``, only what
    goes into that micro-batch's compaction.
    """
    whole = StructType([*schema.fields, StructField("batch", LongType())])
    bases = [n for n in _folders(spark, f"{path}/base", "upto") if before is None or n < before]
    mark = bases[-1] if bases else -1
    batches = [n for n in _folders(spark, f"{path}/data", "batch") if n > mark and (before is None or n <= before)]
    empty = spark.createDataFrame([], whole)
    base = spark.read.schema(whole).parquet(f"{path}/base/upto={mark}") if bases else empty
    if not batches:
        return base
    paths = [f"{path}/data/batch={n}" for n in batches]
    return base.unionByName(spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*paths))


def _writer(path: str, schema: StructType, combine: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch to a folder of its own, and combines what piled up now and then.

    A batch that runs again replaces its folder and, if it was its turn, its compaction, which
    is made of the compaction before and the batches since. Readers take the last complete one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")
        if batch_id % EVERY == EVERY - 1:
            piled = stored(batch.sparkSession, path, schema, before=batch_id)
            combine(piled).write.mode("overwrite").parquet(f"{path}/base/upto={batch_id}")

    return write


def run_totals(daily: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Totals of a stateful stream so far, all days included, the last ones too.

    Each micro-batch writes the totals it changed (update mode); of each key the
    latest stands. A later start with the same path goes on where the last ended.
    """
    rest = [c for c in daily.columns if c not in keys]

    def latest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rest), "batch").alias("_last")
        return rows.groupBy(*keys).agg(last, F.max("batch").alias("batch")).select(*keys, "_last.*", "batch")

    _run(daily, _writer(path, daily.schema, latest), path, "update")
    return latest(stored(daily.sparkSession, path, daily.schema)).drop("batch")


def merge_stream(stream: DataFrame, keys: list[str], sums: dict[str, str], path: str) -> DataFrame:
    """Sums per key over all micro-batches under ``path``.

    ``sums`` names additive measures by the column they add up. A micro-batch adds
    its partial sums in a folder of its own; a batch that runs again after a failure
    replaces that folder, so nothing counts twice and nothing is lost. A later start
    with the same path goes on where the last one ended.
    """
    schema = stream.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).schema

    def added(rows: DataFrame) -> DataFrame:
        totals = [F.sum(n).cast(schema[n].dataType).alias(n) for n in sums]
        return rows.groupBy(*keys).agg(*totals, F.max("batch").alias("batch"))

    write_partial = _writer(path, schema, added)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_partial(batch.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()]), batch_id)

    _run(stream, write, path, "append")
    return added(stored(stream.sparkSession, path, schema)).drop("batch")
