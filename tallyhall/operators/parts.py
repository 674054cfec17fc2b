"""Tables in parts: a batch rewrites the parts it can reach and shares all others.

A version of such a table is a partitioned catalog table whose partitions are its parts.
A part is one folder of files with a narrow range of a clustering column; the partition
values ``_low, _high, _part`` are that range and the part's name, so the catalog is the
manifest and Spark's partition pruning finds the parts that a range can reach. The next
version lists the untouched parts at the places where they already lie, and the new ones;
then the view with the table's name is switched to it. Readers see one version or the
other, and a job that fails leaves the old one. Files of former versions stay.

Rows without a value of the clustering column are in parts as well; a part of such rows
alone has no range and no reload reaches it.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.session import materialise, table_path

ROWS = 1_000_000  # rows of a part that is written anew
LISTED = 500  # parts named in one catalog statement
MARKS = ["_low", "_high", "_part"]
COLUMN, STORED, ROOT = "tallyhall.parts.column", "tallyhall.parts.table", "tallyhall.parts.root"  # properties of the view


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {table}").collect()}


def is_parted(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and STORED in properties(spark, table)


def stored(spark: SparkSession, table: str) -> tuple[DataFrame, str]:
    """The version behind a table, with the marks of its parts, and its clustering column."""
    found = properties(spark, table)
    return spark.table(found[STORED]), found[COLUMN]


def manifest(spark: SparkSession, table: str) -> dict[str, tuple[str | None, str | None]]:
    """Low and high of every part, by name; one line of the catalog each."""
    out = {}
    for r in spark.sql(f"show partitions {properties(spark, table)[STORED]}").collect():
        spec = dict(p.split("=", 1) for p in r["partition"].split("/"))
        out[spec["_part"]] = (_value(spec["_low"]), _value(spec["_high"]))
    return out


def _place(root: str, part: str) -> str:
    """Folder of a part: its name begins with the run that wrote it."""
    return f"{root}/{part.split('-')[0]}/_part={part}"


def _value(text: str) -> str | None:
    return None if text == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mark(df: DataFrame, column: str, value: Column) -> Column:
    """The partition value of an end: text gets a sign in front, as empty text can't be one."""
    return F.concat(F.lit("="), value) if df.schema[column].dataType.typeName() == "string" else value


def _write(df: DataFrame, column: str, root: str, rows: int) -> dict[str, tuple]:
    """Writes new parts and gives the range of each."""
    spark, count = df.sparkSession, df.count()
    if not count:
        return {}
    run = uuid.uuid4().hex[:12]
    spread = F.xxhash64(*df.columns)  # one hot value may be cut over several parts
    ranged = df.repartitionByRange(max(1, -(-count // rows)), F.col(column), spread)
    marked = ranged.withColumn("_part", F.concat(F.lit(f"{run}-"), F.spark_partition_id().cast("string")))
    marked.write.partitionBy("_part").parquet(f"{root}/{run}")
    written = spark.read.schema(marked.schema).parquet(f"{root}/{run}")
    low, high = (_mark(df, column, f(column)).cast("string") for f in (F.min, F.max))
    ends = written.groupBy("_part").agg(low.alias("low"), high.alias("high"))
    return {r["_part"]: (r["low"], r["high"]) for r in ends.collect()}  # one for each part


def _publish(spark: SparkSession, table: str, schema, column: str, parts: dict[str, tuple], root: str) -> None:
    """A new version of the given parts, then the switch to it."""
    name = f"{table}__{uuid.uuid4().hex[:12]}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    kind = schema[column].dataType.simpleString()
    marks = f"_low {kind}, _high {kind}, _part string"
    by = "using parquet partitioned by (_low, _high, _part)"
    spark.sql(f"create table {name} ({fields}, {marks}) {by} location '{root}/none'")
    entries = [
        f"partition (_low = {_literal(low)}, _high = {_literal(high)}, _part = '{part}') location '{_place(root, part)}'"
        for part, (low, high) in parts.items()
    ]
    for i in range(0, len(entries), LISTED):
        spark.sql(f"alter table {name} add {' '.join(entries[i : i + LISTED])}")
    if spark.catalog.tableExists(table) and not is_parted(spark, table):
        spark.sql(f"drop table {table}")  # external: its files stay, and its rows are in the new version
    columns = ", ".join(f"`{f.name}`" for f in schema)
    own = ", ".join(f"'{k}' = '{v}'" for k, v in ((COLUMN, column), (STORED, name), (ROOT, root)))
    spark.sql(f"create or replace view {table} tblproperties ({own}) as select {columns} from {name}")


def write_parts(df: DataFrame, table: str, column: str, rows: int = ROWS) -> None:
    """Replace ``table`` by the rows, in parts of about ``rows`` rows clustered by ``column``."""
    spark = df.sparkSession
    df, root = materialise(df, "parts"), table_path(spark, table)
    _publish(spark, table, df.schema, column, _write(df, column, root, rows), root)


def _guard_types(version: DataFrame, batch: DataFrame, table: str) -> None:
    before = {f.name: f.dataType for f in version.schema}
    if changed := [f.name for f in batch.schema if before.get(f.name, f.dataType) != f.dataType]:
        raise ValueError(f"{table} holds other types of {changed}")


def _rewrite(spark: SparkSession, table: str, touched: set[str], new: DataFrame, rows: int) -> None:
    """The next version: untouched parts where they are, the touched ones replaced by the new rows."""
    column = properties(spark, table)[COLUMN]
    root = properties(spark, table)[ROOT]
    kept = {part: ends for part, ends in manifest(spark, table).items() if part not in touched}
    _publish(spark, table, new.schema, column, kept | _write(new, column, root, rows), root)


def append(spark: SparkSession, table: str, batch: DataFrame, rows: int = ROWS) -> None:
    """Adds the rows of a batch as new parts."""
    columns = spark.table(table).columns
    _guard_types(spark.table(table), batch, table)
    _rewrite(spark, table, set(), materialise(batch.select(*columns), "appended"), rows)


def reload_range(spark: SparkSession, table: str, batch: DataFrame, start, end, rows: int = ROWS) -> set[str]:
    """Replaces the rows with the clustering column in [start, end]; gives the parts rewritten.

    Parts whose range misses [start, end] are neither read nor written. Rows without a
    value are never deleted. Columns that one side lacks are null there.
    """
    version, column = stored(spark, table)
    _guard_types(version, batch, table)
    first, last = (_mark(version, column, F.lit(x)) for x in (start, end))
    parts = version.filter((F.col("_low") <= last) & (F.col("_high") >= first))
    touched = {r["_part"] for r in parts.select("_part").distinct().collect()}  # one for each part
    outside = ~F.col(column).between(F.lit(start), F.lit(end)) | F.col(column).isNull()
    held = parts.filter(outside).drop(*MARKS)
    new = materialise(held.unionByName(batch, allowMissingColumns=True), "reloaded")
    _rewrite(spark, table, touched, new, rows)
    return touched


def merge_keys(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: list[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    rows: int = ROWS,
) -> set[str]:
    """Merges a stored batch into the parts that can hold one of its keys; gives those parts.

    The clustering column must be one of the keys, and null keys must match nothing.
    ``merge(target, batch)`` gives the merged rows. A batch whose keys all fall between the
    parts adds parts and rewrites none.
    """
    version, column = stored(spark, table)
    if column not in keys:
        raise ValueError(f"the clustering column {column} must be one of the merge keys")
    _guard_types(version, batch, table)
    touched = _reached(spark, table, batch, column)
    held = version.filter(F.col("_part").isin(sorted(touched)) if touched else F.lit(False))
    new = materialise(merge(held.drop(*MARKS), batch), "merged")
    _rewrite(spark, table, touched, new, rows)
    return touched


def _reached(spark: SparkSession, table: str, batch: DataFrame, column: str) -> set[str]:
    """Parts whose range holds a value of the batch; both are compared as sorted arrays in tasks."""
    entries = [(part, low, high) for part, (low, high) in manifest(spark, table).items() if low is not None]
    if not entries:
        return set()
    kind = batch.schema[column].dataType
    if kind.typeName() == "string":
        entries = [(part, low[1:], high[1:]) for part, low, high in entries]
    named = spark.createDataFrame(entries, "part string, low string, high string")
    ends = named.select("part", F.col("low").cast(kind).alias("low"), F.col("high").cast(kind).alias("high")).collect()
    shared = spark.sparkContext.broadcast([tuple(r) for r in ends])
    values = batch.select(F.col(column).alias("value")).filter("value is not null").distinct()

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for b in batches:
            value = sorted(b.column("value").to_pylist())
            found |= {part for part, low, high in shared.value if bisect_left(value, low) < bisect_right(value, high)}
        yield pa.record_batch({"part": pa.array(sorted(found), pa.string())})

    return {r["part"] for r in values.mapInArrow(reach, "part string").distinct().collect()}


def files(spark: SparkSession, table: str) -> set[str]:
    """Data files of the current version that hold rows."""
    version, _ = stored(spark, table)
    return {r["f"] for r in version.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
