"""Cleaning and naming expressions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhall.functions import fixed_values as fv


def strip_quote(c: Column) -> Column:
    """Drop every leading apostrophe (spreadsheet text markers)."""
    return F.ltrim(c, F.lit("'"))


def null_if_nan(c: Column) -> Column:
    return F.nullif(c, F.lit("nan"))


def stringify(c: Column) -> Column:
    """Text form in which a missing value reads ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def parse_us_date(c: Column) -> Column:
    """``M/D/YYYY`` with or without leading zeros; anything unreadable is null."""
    return F.try_to_timestamp(c, F.lit("M/d/yyyy")).cast("date")


def parse_money(c: Column) -> Column:
    """``$1,234.56`` as a double; other text is an error."""
    return F.translate(c, "$,", "").cast("double")


def lookback_start(end: Column) -> Column:
    """One year before ``end``; 29 February falls back to the 28th."""
    return F.add_months(end, -12)


def agency_band(code: Column) -> Column:
    """Agency of a department code: first matching band wins, null stays null."""
    band = F.when(F.startswith(code, F.lit("0")) | (F.length(code) < 4), F.lit(fv.FIRST_BAND))
    number = code.cast("int")
    for low, high, agency in fv.AGENCY_BANDS:
        inside = number >= low
        if high is not None:
            inside = inside & (number < high)
        band = band.when(inside, F.lit(agency))
    return band


def class_code(c: Column) -> Column:
    """Description of a census place class code, null for codes not listed."""
    out = F.lit(None).cast("string")
    for code, text in reversed(fv.PLACE_CLASSES.items()):
        out = F.when(c == code, F.lit(text)).otherwise(out)
    return out


def clean_name(c: Column) -> Column:
    """Trim white space of every kind and collapse runs of blanks."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), " {2,}", " ")


def extract_name(c: Column) -> Column:
    """Leading part of a name, before parentheticals and ``- XYZ`` suffixes."""
    return F.coalesce(F.nullif(F.regexp_extract(c, fv.BARE_NAME, 1), F.lit("")), c)


def reorder_name(c: Column) -> Column:
    """File ``Department of X`` under X: ``X, Department of``."""
    name = F.regexp_replace(c, "^([^’]*)’", "$1'")
    units = "|".join(fv.UNIT_PREFIX + unit + fv.UNIT_SUFFIX for unit in fv.UNIT_TYPES)
    pattern = rf"^({units})\s*(.+)$"
    unit, rest = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    words, alias = fv.COMMISSION_ALIAS
    is_alias = F.contains(name, F.lit(words[0])) & F.contains(name, F.lit(words[1]))
    return (
        F.when(name == fv.FILED_AS_IS, name)
        .when(is_alias, F.lit(alias))
        .when((unit != "") & (rest != ""), F.concat(F.trim(rest), F.lit(", "), F.trim(unit)))
        .otherwise(name)
    )


def ucm_level(l3: Column, l2: Column, l1: Column, subagency: Column) -> Column:
    """Depth of an entity in the organisation tree, from its deepest code."""
    return (
        F.when(F.coalesce(l3, l2, l1, subagency).isNull(), "agency")
        .when(F.coalesce(l3, l2, l1).isNull(), "subagency")
        .when(F.coalesce(l3, l2).isNull(), "L1")
        .when(l3.isNull(), "L2")
        .otherwise("L3")
    )


def normalize_columns(df: DataFrame, drop_hash: bool = True) -> DataFrame:
    """Headers to UPPER_SNAKE; ``drop_hash`` also removes ``#`` and trailing ``_``."""

    def rename(name: str) -> str:
        name = re.sub(r"\s+", "_", name.upper())
        return name.replace("#", "").rstrip("_") if drop_hash else name

    return df.toDF(*[rename(c) for c in df.columns])


def camel_to_snake(df: DataFrame) -> DataFrame:
    """Headers from camelCase to snake_case."""
    return df.toDF(*[re.sub(r"(?<!^)([A-Z])", r"_\1", c).lower() for c in df.columns])


def with_loaded_at(df: DataFrame) -> DataFrame:
    return df.withColumn("LOADED_AT", F.current_timestamp())
