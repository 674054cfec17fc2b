"""Table maintenance on plain parquet: replace, append, merge, reload, export.

Tables are never read and overwritten in one path. A new version is written beside
the old one and the catalog table is repointed, so a lost executor or a failed job
leaves the old version in place. Partitioned folders (``merge_partitions``,
``reload_month_partitions``) are rewritten in place by whole partitions: readers at
that moment may see some partitions new and others old.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.functions.geometry import geom_type
from tallyhall.operators import parts
from tallyhall.operators.skew import scatter_nulls
from tallyhall.session import materialise, table_path


def guard_unique(batch: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Refuse a batch that holds a key twice; keys with a null count only if ``null_safe``."""
    rows = batch if null_safe else batch.dropna(subset=keys)
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"the batch holds a key of {keys} more than once")
    return batch


def keyed_merge(
    target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """Target rows whose key is not in ``batch``, plus all of ``batch``.

    By default null keys match nothing, as under SQL ``=``, so such rows pile up
    over repeated runs; ``null_safe`` treats null as an ordinary value. Only the
    keys of ``batch`` are shuffled for the join, and target rows with a null key
    are scattered instead of meeting in one task. ``batch`` is planned twice, so
    hand in a stored one; ``guard_unique`` refuses keys that it holds twice.
    """
    new = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    if null_safe:
        match = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        kept = target.join(new, match, "left_anti")
    else:
        match = [F.col(k) == F.col(f"_new_{k}") for k in keys]
        match.append(F.col("_salt") == F.col("_new_salt"))
        salted = target.withColumn("_salt", scatter_nulls(keys, target.columns))
        kept = salted.join(new.withColumn("_new_salt", F.lit(0)), match, "left_anti")
        kept = kept.drop("_salt")
    return kept.unionByName(batch)


def range_reload(
    target: DataFrame | None, batch: DataFrame, col: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Replace target rows with ``col`` in [start, end], both ends included.

    Rows without a date are never deleted. A missing target is an empty one.
    """
    if target is None:
        return batch
    outside = ~F.col(col).between(F.lit(start), F.lit(end)) | F.col(col).isNull()
    return target.filter(outside).unionByName(batch, allowMissingColumns=True)


def guard_non_empty(df: DataFrame, label: str) -> DataFrame:
    """Refuse to go on with an empty batch, before anything is overwritten."""
    if df.isEmpty():
        raise RuntimeError(f"{label}: empty batch, keeping the existing table")
    return df


def _clustered(df: DataFrame, cluster_by: list[str]) -> DataFrame:
    """Range-partition and sort by the cluster key.

    A hash of the row is the last range column so that one hot key value can
    still be cut over several partitions.
    """
    names = {c.lower(): t for c, t in df.dtypes}
    if any(names.get(c.lower()) == "binary" for c in cluster_by):
        raise ValueError("cannot cluster on a geometry column")
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)


def write_replace(df: DataFrame, table: str, cluster_by: list[str] | None = None) -> str:
    """Write a new version of ``table`` and repoint the catalog to it.

    A managed table is refused: dropping it would delete its files.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} is managed by the catalog; its versions can't be kept")
    path = table_path(spark, table)
    (_clustered(df, cluster_by) if cluster_by else df).write.parquet(path)
    if parts.is_parted(spark, table):  # a view over its parts, whose files stay
        spark.sql(f"drop view {table}")
    if spark.catalog.tableExists(table):
        if [f.dataType for f in spark.table(table).schema] == [
            f.dataType for f in df.schema
        ] and spark.table(table).columns == df.columns:
            spark.sql(f"alter table {table} set location '{path}'")
            spark.catalog.refreshTable(table)
            return path
        new = f"{table}_{path[-8:]}"  # created first, so a failure leaves the old table
        spark.catalog.createTable(new, path=path, source="parquet", schema=df.schema)
        spark.sql(f"drop table {table}")  # external: files of the old version stay
        spark.sql(f"alter table {new} rename to {table}")
        return path
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    return path


def write_append(df: DataFrame, table: str, cluster_by: list[str] | None = None) -> None:
    """Insert into an existing table by column name, or create it.

    A batch must have exactly the table's columns, in any order.
    """
    if cluster_by:
        raise ValueError("clustering an existing table on append is not supported")
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        write_replace(df, table)
        return
    columns = spark.table(table).columns
    if {c.lower() for c in columns} != {c.lower() for c in df.columns}:
        raise ValueError(f"{table} has the columns {columns}, the batch {df.columns}")
    if parts.is_parted(spark, table):
        parts.append(spark, table, df)
    else:
        df.select(*columns).write.insertInto(table)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"create database if not exists {name}")


def schema_name(custom: str | None, target: str, environment: str) -> str:
    """Schema of a model: its own name in production, prefixed elsewhere."""
    if custom is None:
        return target.lower().strip()
    if environment == "prd":
        return custom.lower().strip()
    return f"{target.lower().strip()}_{custom.strip()}"


INCREMENTAL = "tallyhall.incremental"  # table property


def _properties(spark: SparkSession, table: str) -> set[str]:
    return {r["key"] for r in spark.sql(f"show tblproperties {table}").collect()}


def materialize(
    df: DataFrame,
    name: str,
    layer: str,
    kind: str,
    keys: list[str] | None = None,
    limit: int | None = None,
    target: str = "dev",
    environment: str = "dev",
    full_refresh: bool = False,
) -> str:
    """Publish a model as a view, a table or a keyed incremental table.

    A view must be built from catalog tables; it is registered for the session.
    ``limit`` keeps a few rows of a view only, for development: it would cut a stored
    table. An incremental table holds history its source may have lost, so it is built
    anew only with ``full_refresh``. It is kept in parts by its date key (else its first
    key), and a run rewrites only the parts that its keys can be in.
    """
    spark = df.sparkSession
    if limit is not None:
        if kind != "view":
            raise ValueError("a limit would cut the stored table")
        df = df.limit(limit)
    if kind == "view":
        df.createOrReplaceTempView(name)
        return name
    database = schema_name(layer, target, environment)
    ensure_database(spark, database)
    table = f"{database}.{name}"
    exists = spark.catalog.tableExists(table)
    if kind == "table":
        if exists and not full_refresh and INCREMENTAL in _properties(spark, table):
            raise ValueError(f"{table} is incremental; rebuild it with full_refresh")
        write_replace(df, table)
    elif kind == "incremental":
        if not keys:
            raise ValueError("an incremental model needs its merge keys")
        column = _part_column(df, keys)
        if exists and not full_refresh:
            batch = guard_unique(materialise(df, "model"), keys)
            if parts.is_parted(spark, table) and parts.stored(spark, table)[1] == column:
                parts.merge_keys(spark, table, batch, keys, lambda held, new: keyed_merge(held, new, keys))
            else:
                parts.write_parts(keyed_merge(spark.table(table), batch, keys), table, column)
        else:
            parts.write_parts(df, table, column)
        spark.sql(f"alter view {table} set tblproperties ('{INCREMENTAL}' = 'true')")
    else:
        raise ValueError(f"unknown materialisation {kind!r}")
    return table


def _part_column(df: DataFrame, keys: list[str]) -> str:
    """The key that the parts of an incremental table are cut by."""
    return next((k for k in keys if df.schema[k].dataType.typeName() in ("date", "timestamp")), keys[0])


def reload_table(
    spark: SparkSession, table: str, batch: DataFrame, col: str, start: dt.date, end: dt.date
) -> None:
    """``range_reload`` on a catalog table; a table not there yet is created.

    The table is kept in parts by ``col``; only parts that [start, end] meets are rewritten.
    A table that is not in parts yet is read and written whole once.
    """
    if parts.is_parted(spark, table) and parts.stored(spark, table)[1] == col:
        parts.reload_range(spark, table, batch, start, end)
        return
    target = spark.table(table) if spark.catalog.tableExists(table) else None
    parts.write_parts(range_reload(target, batch, col, start, end), table, col)


def reload_month_partitions(
    spark: SparkSession, path: str, batch: DataFrame, col: str, start: dt.date, end: dt.date
) -> None:
    """``range_reload`` on files partitioned by ``month``, touching only months it must.

    Months wholly outside [start, end] that the batch does not reach are neither
    read nor written. The rows to write are materialised before anything is
    replaced; the folder of a month left without rows is removed.
    """
    month = F.date_format(col, "yyyy-MM")
    batch = batch.withColumn("month", F.coalesce(month, F.lit("none")))
    reached = {r[0] for r in batch.select("month").distinct().collect()}  # one per month
    stored = spark.read.option("basePath", path).schema(batch.schema).parquet(path)
    first, last = f"{start:%Y-%m}", f"{end:%Y-%m}"
    touched = F.col("month").between(first, last) | F.col("month").isin(*reached)
    held = [r[0] for r in stored.select("month").filter(touched).distinct().collect()]
    new = range_reload(stored.filter(touched), batch, col, start, end)
    new = materialise(new, "reload")
    new.hint("rebalance", "month").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("month").parquet(path)
    filled = {r[0] for r in new.select("month").distinct().collect()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    for gone in set(held) - filled:
        folder = hadoop.Path(f"{path}/month={gone}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    part: str,
    null_safe: bool = False,
) -> None:
    """``keyed_merge`` on files partitioned by ``part``, which is one of the keys.

    Only partitions the batch reaches can hold a row to replace; the others are
    neither read nor written. A batch that runs again replaces its own rows.
    """
    if part not in keys:
        raise ValueError("the partition column must be one of the merge keys")
    batch = guard_unique(materialise(batch, "batch"), keys, null_safe)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        reached = [r[0] for r in batch.select(part).distinct().collect()]  # one per partition
        stored = spark.read.schema(batch.schema).parquet(path)
        values = [v for v in reached if v is not None]
        hit = F.col(part).isin(values) if values else F.lit(False)
        if None in reached:
            hit = hit | F.col(part).isNull()
        batch = materialise(keyed_merge(stored.filter(hit), batch, keys, null_safe), "merged")
    batch.hint("rebalance", part).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(part).parquet(path)


def export_partitions(
    df: DataFrame, path: str, key: str, geom: str | None = None, drop_collections: bool = True
) -> None:
    """One folder of parquet files per non-null ``key`` value.

    The rebalance hint gathers small keys into single files and lets adaptive
    execution cut a key too large for one task.
    """
    rows = df.filter(F.col(key).isNotNull())
    if geom is not None and drop_collections:
        rows = rows.filter(F.coalesce(geom_type(F.col(geom)) != 7, F.lit(True)))
    rows.hint("rebalance", key).write.partitionBy(key).parquet(path)


def partition_values(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null values of the export key, in order."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)


def read_partition(spark: SparkSession, path: str, key: str, value: str, schema: str) -> DataFrame:
    """Rows of one exported key. Keys compare as text, so leading zeros count."""
    return spark.read.schema(schema).parquet(path).filter(F.col(key) == F.lit(value))
