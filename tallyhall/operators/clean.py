"""Landed procurement records: combine, deduplicate, type and band."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.functions import text as tx
from tallyhall.operators.tables import guard_non_empty

PURCHASE_KEY = ["Purchase Document #", "Department"]


def concat_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key in ``order``; null key values compare equal.

    An aggregate rather than a window: copies of a hot key collapse map-side
    instead of being sorted together in one task.
    """
    q = [F.col(f"`{c}`") for c in df.columns]
    last = F.max_by(F.struct(*q), F.struct(*order)).alias("_row")
    grouped = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(last)
    return grouped.select("_row.*")


def clean_purchases(
    goods: DataFrame, services: DataFrame, seq: str, loaded_at: bool = False
) -> DataFrame:
    """Combine both acquisition types, keep the last row per document and
    department, then parse dates and money and normalise the headers."""
    both = concat_by_name(
        goods.withColumn("acquisition_type", F.lit("IT Goods")).withColumn("_part", F.lit(0)),
        services.withColumn("acquisition_type", F.lit("IT Services")).withColumn("_part", F.lit(1)),
    )
    last = dedup_keep_last(both, PURCHASE_KEY, ["_part", seq]).drop("_part", seq)
    parsers = {
        "Start Date": tx.parse_us_date,
        "End Date": tx.parse_us_date,
        "Grand Total": tx.parse_money,
    }
    typed = last.withColumns({c: f(F.col(c)) for c, f in parsers.items() if c in last.columns})
    out = tx.normalize_columns(typed)
    return tx.with_loaded_at(out) if loaded_at else out


def clean_contracts(expired: DataFrame, active: DataFrame, loaded_at: bool = False) -> DataFrame:
    """Both contract listings as one snapshot; either one empty is an error."""
    guard_non_empty(expired, "expired contracts")
    guard_non_empty(active, "active contracts")
    both = concat_by_name(
        expired.withColumn("status", F.lit("expired")),
        active.withColumn("status", F.lit("active")),
    )
    texts = [c for c, t in both.dtypes if t == "string"]
    both = both.withColumns({c: tx.stringify(F.col(f"`{c}`")) for c in texts})
    dates = [c for c in ("Begin  Date", "Expire  Date") if c in both.columns]
    typed = both.withColumns({c: tx.parse_us_date(F.col(f"`{c}`")) for c in dates})
    out = tx.normalize_columns(typed, drop_hash=False)
    return tx.with_loaded_at(out) if loaded_at else out


def stage_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.select(
        tx.strip_quote(F.col("purchase_document")).alias("purchase_document"),
        F.col("department").cast("string").alias("department"),
        "department_name",
        F.col("first_item_title").alias("description"),
        tx.strip_quote(F.col("supplier_id")).alias("supplier_id"),
        "supplier_name",
        "start_date",
        "end_date",
        "grand_total",
        tx.strip_quote(F.col("associated_pos")).alias("associated_pos"),
        "lpa_contract_id",
        "acquisition_type",
    )


def purchases_mart(staged: DataFrame) -> DataFrame:
    return staged.withColumn("agency", tx.agency_band(F.col("department")))


def stage_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        "contract_id",
        "contract_description",
        "supplier_id",
        "supplier_name",
        tx.null_if_nan(F.col("buyer")).alias("buyer"),
        "begin_date",
        "expire_date",
        "contract_type",
        tx.null_if_nan(F.col("certification_type")).alias("certification_type"),
        "acquisition_type",
        "status",
    )


def contracts_mart(staged: DataFrame) -> DataFrame:
    return staged.select("*")
