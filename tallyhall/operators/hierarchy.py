"""Organisation tree from indented text lines, and budgets from nested records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.functions import fixed_values as fv
from tallyhall.functions.text import camel_to_snake, clean_name


def skip_line(line: Column) -> Column:
    """Whether a line of the manual carries no entity: blank, page number or heading.

    Phrases may stand anywhere in a line. The slow search runs only on lines that
    hold a word of one, and without the blanks in front of each phrase, which
    decide nothing but make the matcher start over on indented lines.
    """
    whole = [p for p in fv.SKIP_LINES if p.startswith("^")]
    phrases = [p.removeprefix(r"(\s*)") for p in fv.SKIP_LINES if not p.startswith("^")]
    upper = F.upper(line)
    hinted = reduce(lambda a, b: a | b, [F.contains(upper, F.lit(h)) for h in fv.SKIP_HINTS])
    found = line.rlike("(?U)" + "|".join(whole))
    return found | (hinted & line.rlike("(?iU)" + "|".join(phrases)))


def parse_hierarchy(
    lines: DataFrame,
    doc: str = "doc",
    line_no: str = "line_no",
    line: str = "line",
    step: int = fv.INDENT_STEP,
    skip: Callable[[Column], Column] = skip_line,
    chunk_lines: int = 100_000,
) -> DataFrame:
    """One row per entity with the codes of its ancestors by level.

    The first entity of a document fixes its indent. An entity clears all deeper
    levels. Other lines continue the name before them; one before any entity, or
    an entity deeper than the last level, is an error.

    A document of any length is cut into runs of ``chunk_lines`` lines. Each run
    is reduced to the last entity seen per indent, these small rows are scanned in
    order, and every run then starts from the state carried into it, so no task
    ever holds a whole document.
    """
    depth = len(fv.LEVELS)
    entity = "(?U)" + fv.ENTITY_LINE
    kept = lines.select(
        F.col(doc).alias("doc"), F.col(line_no).alias("line_no"), F.col(line).alias("_line")
    ).filter(~skip(F.col("_line")))
    coded = kept.withColumn("code", F.nullif(F.regexp_extract("_line", entity, 2), F.lit("")))
    is_entity = F.col("code").isNotNull()
    parsed = coded.select(
        "doc",
        "line_no",
        F.floor(F.col("line_no") / chunk_lines).alias("chunk"),
        F.when(is_entity, F.length("_line") - F.length(F.ltrim("_line"))).alias("spaces"),
        "code",
        clean_name(
            F.when(is_entity, F.regexp_extract("_line", entity, 3)).otherwise(F.col("_line"))
        ).alias("text"),
    )

    # State of each run: one row per indent width, first and last line at it.
    by_doc = Window.partitionBy("doc")
    widths = (
        parsed.groupBy("doc", "chunk", "spaces")
        .agg(
            F.min("line_no").alias("first_line"),
            F.max(F.struct("line_no", "code")).alias("last"),
        )
        .withColumn(
            "indent",
            F.min(F.when(F.col("spaces").isNotNull(), F.struct("first_line", "spaces"))).over(
                by_doc
            )["spaces"],
        )
        .withColumn("level", F.floor((F.col("spaces") - F.col("indent")) / step))
    )
    runs = widths.groupBy("doc", "chunk").agg(
        F.first("indent").alias("indent"),
        F.max(F.when(F.col("spaces").isNotNull(), F.col("last.line_no"))).alias("last_entity"),
        *[
            F.max(
                F.when(F.col("level") <= k, F.struct("last.line_no", "level", "last.code"))
            ).alias(f"end_{k}")
            for k in range(depth)
        ],
    )
    before = Window.partitionBy("doc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select(
        "doc",
        "chunk",
        "indent",
        F.max("last_entity").over(before).alias("in_entity"),
        *[F.max(f"end_{k}").over(before).alias(f"in_{k}") for k in range(depth)],
    )

    # Every line sees the last entity at or above each level, in its run or carried in.
    located = parsed.join(carried, ["doc", "chunk"]).withColumn(
        "level", F.floor((F.col("spaces") - F.col("indent")) / step)
    )
    so_far = (
        Window.partitionBy("doc", "chunk")
        .orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    state = located.select(
        "doc",
        "chunk",
        "line_no",
        "text",
        "level",
        "in_entity",
        F.last(F.when(F.col("level").isNotNull(), F.col("line_no")), ignorenulls=True)
        .over(so_far)
        .alias("own_entity"),
        *[
            F.coalesce(
                F.last(
                    F.when(F.col("level") <= k, F.struct("line_no", "level", "code")),
                    ignorenulls=True,
                ).over(so_far),
                f"in_{k}",
            ).alias(f"at_{k}")
            for k in range(depth)
        ],
    )
    codes = [
        F.when(F.col(f"at_{k}.level") == k, F.col(f"at_{k}.code")).alias(name)
        for k, name in enumerate(fv.LEVELS)
    ]
    orphan = F.raise_error(F.lit("text before the first entity"))
    too_deep = F.raise_error(F.concat(F.lit("entity out of levels: "), F.col("text")))
    pieces = state.select(
        "doc",
        "chunk",
        "line_no",
        F.coalesce("own_entity", "in_entity", orphan).alias("entity_line"),
        F.when((F.col("level") >= depth) | (F.col("level") < -1), too_deep)
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("level").isNotNull(), F.struct(*codes)).alias("codes"),
    )

    def joined_text(order: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(order, "text")))
        return F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text")

    # Same partitioning as the window above: no further shuffle of the lines.
    named = pieces.groupBy("doc", "chunk", "entity_line").agg(
        joined_text("line_no"), F.max("codes").alias("codes")
    )
    # A name may continue in later runs, with one piece in each.
    return (
        named.groupBy("doc", F.col("entity_line").alias("line_no"))
        .agg(joined_text("chunk").alias("name"), F.max("codes").alias("codes"))
        .select("doc", "line_no", "codes.*", "name")
    )


def flatten_budgets(
    agencies: DataFrame, departments: DataFrame, programs: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Agency and department records as one table, program lines as another."""
    organisations = agencies.unionByName(departments, allowMissingColumns=True)
    lines = programs.select(F.explode("lines").alias("line")).select("line.*")
    return camel_to_snake(organisations), camel_to_snake(lines)
