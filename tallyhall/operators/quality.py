"""Data-quality checks. Each returns failing rows or a report as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_ID = ["database", "schema", "table"]


def not_null(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """Rows in which any of ``cols`` is null."""
    cols = [cols] if isinstance(cols, str) else cols
    failing = F.lit(False)
    for c in cols:
        failing = failing | F.col(c).isNull()
    return df.filter(failing)


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur more than once; nulls are not compared."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col)
    return counts.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations that occur more than once; null counts as a value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def assert_no_rows(failing: DataFrame, label: str) -> None:
    n = failing.count()
    if n:
        raise ValueError(f"{label}: {n} failing rows")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Number of child rows without a parent, as one row ``orphans``.

    Child rows are counted per key before the join, so a key that holds most of
    the table enters it as one row. Null keys have no parent either.
    """
    counts = child.groupBy(F.col(fk).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(pk).alias("_key")).distinct()
    return counts.join(keys, "_key", "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("orphans")
    )


def assert_no_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> None:
    n = orphans(child, parent, fk, pk).first()["orphans"]
    if n:
        raise ValueError(f"{n} rows of {fk} have no parent")


def profile(df: DataFrame, measure: str, status: str) -> DataFrame:
    """Overall statistics of ``measure`` and row counts by ``status``, long form.

    Statistics of an empty input are zero. Totals are rebuilt from the per-status
    rows, so the input is read and shuffled once.
    """
    m = F.col(measure)
    by_status = df.groupBy(F.col(status).alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(m).alias("n_measured"),
        F.min(m).alias("low"),
        F.max(m).alias("high"),
        F.sum(m).alias("total"),
    )
    overall = by_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("count"),
        (F.sum("total") / F.sum("n_measured")).cast("double").alias("avg"),
        F.min("low").cast("double").alias("min"),
        F.max("high").cast("double").alias("max"),
        F.sum("total").cast("double").alias("total"),
    )
    names = ["count", "avg", "min", "max", "total"]
    pairs = [
        F.struct(F.lit(n).alias("metric"), F.coalesce(F.col(n), F.lit(0.0)).alias("value"))
        for n in names
    ]
    stats = overall.select(F.inline(F.array(*pairs)))
    counts = by_status.select(
        F.concat(F.lit("status "), F.coalesce("status", F.lit("null"))).alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    return stats.unionByName(counts.orderBy(F.desc("value"), "metric"))


def status_breakdown(df: DataFrame, status: str) -> DataFrame:
    """Row count per status, most frequent first."""
    counts = df.groupBy(status).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), status)


def validate_schemas(
    contracts: DataFrame,
    actual: DataFrame,
    errors_only: bool = False,
    undocumented_as_errors: bool = True,
) -> DataFrame:
    """Compare documented with actual columns, one report row per documented table.

    ``contracts`` has database, schema, table, resource_type, column (null for a
    table without documented columns); ``actual`` has database, schema, table,
    column. Names compare without case. ``issues`` lists TABLE_NOT_FOUND,
    DOCUMENTED_BUT_MISSING_COLUMNS and UNDOCUMENTED_COLUMNS; ``failed`` says
    whether any of them counts as an error.
    """
    upper = [F.upper(c).alias(c) for c in TABLE_ID]
    documented = contracts.select(
        *upper, "resource_type", F.upper("column").alias("column"), F.lit(1).alias("d")
    )
    present = actual.select(*upper, F.upper("column").alias("column"), F.lit(1).alias("p"))
    # One row per column, then one per table: both shuffles carry combined rows.
    columns = (
        documented.unionByName(present, allowMissingColumns=True)
        .groupBy(*TABLE_ID, "column")
        .agg(
            F.max("resource_type").alias("resource_type"),
            F.max("d").alias("d"),
            F.max("p").alias("p"),
        )
    )

    def names(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.col("column"))))

    tables = (
        columns.groupBy(*TABLE_ID)
        .agg(
            F.max("resource_type").alias("resource_type"),
            F.max("d").alias("known"),
            F.max("p").alias("found"),
            names(F.col("d").isNotNull() & F.col("p").isNull()).alias("missing_columns"),
            names(F.col("d").isNull() & F.col("p").isNotNull()).alias("undocumented_columns"),
        )
        .filter("known is not null")
    )
    gone = F.col("found").isNull()
    empty = F.array().cast("array<string>")
    has_missing, has_extra = F.size("missing_columns") > 0, F.size("undocumented_columns") > 0
    report = tables.select(
        *TABLE_ID,
        "resource_type",
        F.when(gone, F.array(F.lit("TABLE_NOT_FOUND")))
        .otherwise(
            F.array_compact(
                F.array(
                    F.when(has_missing, F.lit("DOCUMENTED_BUT_MISSING_COLUMNS")),
                    F.when(has_extra, F.lit("UNDOCUMENTED_COLUMNS")),
                )
            )
        )
        .alias("issues"),
        F.when(gone, empty).otherwise(F.col("missing_columns")).alias("missing_columns"),
        F.when(gone, empty).otherwise(F.col("undocumented_columns")).alias("undocumented_columns"),
        (gone | has_missing | (has_extra & F.lit(undocumented_as_errors))).alias("failed"),
    )
    return report.filter("failed") if errors_only else report


def assert_schemas(report: DataFrame) -> None:
    """Raise when any table of a schema report failed."""
    n = report.filter("failed").count()
    if n:
        raise ValueError(f"schema validation failed for {n} tables")


def actual_columns(df: DataFrame, database: str, schema: str, table: str) -> DataFrame:
    """Column list of a DataFrame in the shape ``validate_schemas`` reads."""
    rows = [(database, schema, table, c) for c in df.columns]
    types = "database string, schema string, table string, column string"
    return df.sparkSession.createDataFrame(rows, types)
