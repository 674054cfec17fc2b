"""Daily usage totals, their account-level rollups and the long cost table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCOUNT_DAY = ["organization_name", "account_name", "usage_date"]


@dataclass(frozen=True)
class UsageSpec:
    """One daily model: what is grouped, what is measured, what is kept."""

    source: str
    keys: list[str]
    sums: list[str] = field(default_factory=list)
    avgs: list[str] = field(default_factory=list)
    where: str | None = None
    derived: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)


CREDITS = [
    "credits_used_compute",
    "credits_used_cloud_services",
    "credits_adjustment_cloud_services",
    "credits_used",
    "credits_billed",
]
TABLE_KEYS = ["database_name", "schema_name", "table_name"]


def specs() -> dict[str, UsageSpec]:
    """The ten daily usage models; each key list is also the model's merge key."""
    org, day = ACCOUNT_DAY[:2], ACCOUNT_DAY[2:]
    return {
        "automatic_clustering_history": UsageSpec(
            "automatic_clustering_history",
            [*org, *TABLE_KEYS, *day],
            sums=["credits_used", "num_rows_reclustered", "num_bytes_reclustered"],
        ),
        "cortex_usage_daily_history": UsageSpec(
            "metering_daily_history",
            ACCOUNT_DAY,
            sums=CREDITS,
            where="service_type = 'AI_SERVICES'",
        ),
        "data_transfer_history": UsageSpec(
            "data_transfer_history",
            [*ACCOUNT_DAY, "source_cloud", "source_region", "target_cloud", "target_region"],
            sums=["bytes_transferred"],
        ),
        "database_storage_usage_history": UsageSpec(
            "database_storage_usage_history",
            [*org, "database_name", *day],
            avgs=[
                "average_hybrid_table_storage_bytes",
                "average_database_bytes",
                "average_failsafe_bytes",
            ],
        ),
        "materialized_view_refresh_history": UsageSpec(
            "materialized_view_refresh_history",
            [*org, *TABLE_KEYS, *day],
            sums=["credits_used"],
        ),
        "metering_daily_history": UsageSpec("metering_daily_history", ACCOUNT_DAY, sums=CREDITS),
        "pipe_usage_history": UsageSpec(
            "pipe_usage_history",
            [*org, "pipe_name", *day],
            sums=["bytes_inserted", "files_inserted", "credits_used"],
        ),
        "stage_storage_usage_history": UsageSpec(
            "stage_storage_usage_history", ACCOUNT_DAY, avgs=["average_stage_bytes"]
        ),
        "storage_daily_history": UsageSpec(
            "storage_daily_history",
            ACCOUNT_DAY,
            sums=["credits"],
            avgs=["average_bytes"],
            renames={"credits": "credits_used"},
        ),
        "warehouse_metering_history": UsageSpec(
            "warehouse_metering_history",
            [*org, "warehouse_name", *day],
            sums=["credits_used", "credits_used_compute", "credits_used_cloud_services"],
            derived={"usage_date": "start_time"},
        ),
    }


# usage_type label of the long cost table -> the daily model it comes from
COST_TYPES = {
    "automatic clustering": "automatic_clustering_history",
    "materialized view": "materialized_view_refresh_history",
    "pipe": "pipe_usage_history",
    "storage": "storage_daily_history",
    "warehouse": "warehouse_metering_history",
    "cortex": "cortex_usage_daily_history",
}


def usage_daily(df: DataFrame, spec: UsageSpec) -> DataFrame:
    """Totals and means per key. Null key values form a group of their own.

    Only grouped and measured columns leave the scan, the filter is pushed down
    and the aggregate combines map-side, so a hot key costs no more than others.
    """
    if spec.where is not None:
        df = df.filter(spec.where)
    keys = [
        F.to_date(spec.derived[k]).alias(k) if k in spec.derived else F.col(k) for k in spec.keys
    ]
    measures = [F.sum(c).alias(spec.renames.get(c, c)) for c in spec.sums]
    measures += [F.avg(c).alias(spec.renames.get(c, c)) for c in spec.avgs]
    return df.groupBy(*keys).agg(*measures)


def usage_rollup(daily: DataFrame) -> DataFrame:
    """Credits per organisation, account and day from a finer daily model."""
    return daily.groupBy(*ACCOUNT_DAY).agg(F.sum("credits_used").alias("credits_used"))


def account_credits(df: DataFrame, spec: UsageSpec) -> DataFrame:
    """``usage_rollup(usage_daily(df, spec))`` straight from the source rows.

    Sums of sums are sums, so the finer daily rows need not be shuffled when only
    the rollup is wanted: one exchange of account-days instead of two.
    """
    source = {new: old for old, new in spec.renames.items()}.get("credits_used", "credits_used")
    if source not in spec.sums:
        raise ValueError(f"{spec.source} has no summed credits")
    coarse = replace(
        spec, keys=ACCOUNT_DAY, sums=[source], avgs=[], renames={source: "credits_used"}
    )
    return usage_daily(df, coarse)


def costs_long(rollups: dict[str, DataFrame]) -> DataFrame:
    """One row per account, day and kind of usage; organisations are not kept."""
    parts = [
        df.select("account_name", "usage_date", F.lit(kind).alias("usage_type"), "credits_used")
        for kind, df in rollups.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _month_start(asof: str) -> Column:
    return F.date_trunc("month", F.to_date(F.lit(asof)))


def top_queries(log: DataFrame, asof: str, user: str | None = None, n: int = 20) -> DataFrame:
    """Query texts with most execution minutes since the first of the month."""
    rows = log.filter(F.col("start_time") >= _month_start(asof))
    if user is not None:
        rows = rows.filter(F.col("user_name") == user)
    return (
        rows.groupBy("query_text")
        .agg(
            (F.sum("execution_time") / 60000).alias("total_exec_time_mins"),
            F.sum("credits_used_cloud_services").alias("total_credits_used"),
        )
        .orderBy(F.desc("total_exec_time_mins"), "query_text")
        .limit(n)
    )


def slowest_queries(
    log: DataFrame, user: str, like: str | None = None, n: int = 20
) -> DataFrame:
    """Single slowest runs of one user, optionally only texts LIKE a pattern."""
    rows = log.filter(F.col("user_name") == user)
    if like is not None:
        rows = rows.filter(F.col("query_text").like(like))
    return rows.orderBy(F.desc("execution_time"), "query_text").limit(n)


def minutes_by_query(log: DataFrame, like: str | None = None) -> DataFrame:
    """Execution minutes per query text."""
    if like is not None:
        log = log.filter(F.col("query_text").like(like))
    return log.groupBy("query_text").agg(
        (F.sum("execution_time") / 60000).alias("total_exec_time_mins")
    )


def credits_by_warehouse(metering: DataFrame, asof: str) -> DataFrame:
    """Credits per warehouse since the first of the month, largest first."""
    return (
        metering.filter(F.col("start_time") >= _month_start(asof))
        .groupBy("warehouse_name")
        .agg(F.sum("credits_used").alias("total_credits_used"))
        .orderBy(F.desc("total_credits_used"), "warehouse_name")
    )
