"""Organisation entities: staging, active and technical splits, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.functions import fixed_values as fv
from tallyhall.functions import text as tx
from tallyhall.operators.skew import skew_join


def stage_entities(base: DataFrame) -> DataFrame:
    """Names, codes and flags of every entity.

    A subagency code is blanked when any entity carrying it says so in its name.
    """
    invalid = (
        base.filter(
            F.contains("name", F.lit("no subagency")) & F.contains("name", F.lit("do not use"))
        )
        .select("b")
        .distinct()
        .withColumn("_invalid", F.lit(True))
    )
    flagged = skew_join(base, invalid, ["b"], "left")
    name = F.col("name")
    staged = flagged.select(
        tx.extract_name(name).alias("name"),
        F.coalesce("l3", "l2", "l1", "b", "a").alias("primary_code"),
        F.col("a").alias("agency_code"),
        F.when(F.col("_invalid").isNull(), F.col("b")).alias("subagency_code"),
        "l1",
        "l2",
        "l3",
        F.regexp_substr(name, F.lit(fv.PARENTHETICAL)).alias("parenthetical"),
        F.contains(F.lower(name), F.lit("do not use")).alias("do_not_use"),
        F.contains(F.lower(name), F.lit("abolished")).alias("abolished"),
        F.regexp_substr(name, F.lit(fv.RESTRICTED_USE)).alias("restricted_use"),
        name.alias("name_raw"),
    )
    return staged.withColumns(
        {
            "name_alpha": tx.reorder_name(F.col("name")),
            "ucm_level": tx.ucm_level(
                F.col("l3"), F.col("l2"), F.col("l1"), F.col("subagency_code")
            ),
        }
    )


def _in_use(staged: DataFrame) -> DataFrame:
    return staged.filter(~F.col("do_not_use") & ~F.col("abolished"))


def active(staged: DataFrame, match: str = "full") -> DataFrame:
    """Entities in use. ``match`` says whether a moved/renumbered note must be the
    whole name (``full``) or may stand anywhere in it (``search``)."""
    if match not in ("full", "search"):
        raise ValueError("match is 'full' or 'search'")
    pattern = fv.MOVED_OR_RENUMBERED
    if match == "full":
        pattern = f"^(?:{pattern})$"
    return _in_use(staged).filter(
        F.col("restricted_use").isNull()
        & (F.col("primary_code").cast("int") < fv.TECHNICAL_CODES_FROM)
        & ~F.lower("name_raw").rlike(pattern)
    )


def technical(staged: DataFrame) -> DataFrame:
    """Entities in use that are restricted or carry a bookkeeping code."""
    return _in_use(staged).filter(
        F.col("restricted_use").isNotNull()
        | (F.col("primary_code").cast("int") >= fv.TECHNICAL_CODES_FROM)
    )


def agencies(active_entities: DataFrame) -> DataFrame:
    return active_entities.filter(F.col("subagency_code").isNull() & F.col("l1").isNull()).select(
        "agency_code", "name"
    )


def stage_budgets(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("web_agency_cd").alias("primary_code"),
        F.col("legal_titl").alias("name"),
        F.col("all_budget_year_dols").alias("budget_year_dollars"),
    )


def entity_budgets(active_entities: DataFrame, budgets: DataFrame) -> DataFrame:
    """Departments and above with their budgets; several budgets make several rows.

    Sorted by code; the further sort columns let a hot code span tasks.
    """
    departments = active_entities.filter(F.coalesce("l2", "l3").isNull()).select(
        "primary_code", "ucm_level", "name", "name_alpha"
    )
    lines = budgets.withColumnRenamed("name", "budget_name")
    joined = skew_join(departments, lines, ["primary_code"], "left")
    return joined.select(
        "primary_code", "ucm_level", "name", "name_alpha", "budget_name", "budget_year_dollars"
    ).orderBy("primary_code", "name", "budget_name", "budget_year_dollars")
