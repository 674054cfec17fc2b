"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_HOT = 512  # keys dealt out at most; any further key holds under 1/512 of the rows
MAX_SALTS = 1024
COUNTERS = 4 * MAX_HOT  # keys a summary holds: one with more than a share of 1 / COUNTERS is never lost
LEAST_BYTES = 8  # of a row; a smaller table can't hold a hot key
HOW = ("inner", "left", "left_semi", "left_anti")


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def scatter_nulls(keys: list[str], cols: list[str]) -> Column:
    """Join salt that spreads rows with a null key, zero for all others.

    Such rows match nothing under ``=`` but would all be shuffled to one task.
    """
    return F.when(any_null(keys), F.pmod(F.xxhash64(*cols), F.lit(1 << 16))).otherwise(0).cast("int")


def heavy_keys(sides: list[DataFrame], keys: list[str], counters: int = COUNTERS) -> DataFrame:
    """``side, *keys, _n, _missed``: the keys that may be frequent on each side, by one pass over the keys.

    A summary of at most ``counters`` keys a task and side (Misra and Gries): when there are
    more, all counts go down by the largest that has to go, so what is left counts at most
    ``rows / counters`` too few. Summaries add up, so only they are shuffled: ``_n`` is a lower
    bound of a key's rows, and the ``_missed`` of all tasks together how many it may lack.
    """
    count = len(sides)
    kinds = [f"`{k}` {t}" for k, t in sides[0].select(*keys).dtypes]
    both = reduce(lambda x, y: x.unionByName(y), [df.select(F.lit(i).alias("side"), *keys) for i, df in enumerate(sides)])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, missed = None, {}

        def trimmed(table: pa.Table) -> pa.Table:
            parts = []
            for side in range(count):
                own = table.filter(pa.compute.equal(table.column("side"), side)).sort_by([("_n", "descending")])
                if own.num_rows > counters:
                    cut = own.column("_n")[counters].as_py()
                    missed[side] = missed.get(side, 0) + cut
                    own = own.slice(0, counters)
                    own = own.set_column(own.schema.get_field_index("_n"), "_n", pa.compute.subtract(own.column("_n"), cut))
                    own = own.filter(pa.compute.greater(own.column("_n"), 0))
                parts.append(own)
            return pa.concat_tables(parts)

        names = ["side", *keys]
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")])
            found = found.rename_columns([*names, "_n"])
            if held is not None:
                both_ = pa.concat_tables([held, found]).group_by(names).aggregate([("_n", "sum")])
                found = both_.rename_columns([*names, "_n"])
            held = found if found.num_rows <= 2 * counters else trimmed(found)
        if held is not None:
            held = trimmed(held)
            lost = pa.array([missed.get(x, 0) for x in held.column("side").to_pylist()], pa.int64())
            yield from held.append_column("_missed", lost).to_batches()

    schema = f"side int, {', '.join(kinds)}, _n long, _missed long"
    found = both.mapInArrow(summarise, schema)
    return found.groupBy("side", *keys).agg(F.sum("_n").alias("_n"), F.max("_missed").alias("_missed"))


def hot_keys(sides: list[DataFrame], keys: list[str], min_rows: int) -> list[DataFrame | None]:
    """For each side the largest keys above ``min_rows`` rows with a salt count, None without any.

    Keys are looked for where a side is estimated to hold that many rows at all; at most
    MAX_HOT rows a side come back, so the lists are always safe to broadcast.
    """
    spark = sides[0].sparkSession
    large = [i for i, df in enumerate(sides) if _bytes(df) >= min_rows * LEAST_BYTES]
    if not large:
        return [None] * len(sides)
    found = heavy_keys([sides[i] for i in large], keys).filter(F.col("_n") > min_rows)
    order = Window.partitionBy("side").orderBy(F.desc("_n"))  # a few thousand rows at most
    rows = found.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= MAX_HOT)
    salts = F.least(F.ceil(F.col("_n") / F.lit(min_rows)), F.lit(MAX_SALTS)).cast("int").alias("_salts")
    hot = rows.select("side", *keys, salts)
    listed, out = hot.collect(), [None] * len(sides)
    schema = hot.drop("side").schema
    for at, i in enumerate(large):
        own = [tuple(r)[1:] for r in listed if r["side"] == at]
        out[i] = spark.createDataFrame(own, schema) if own else None
    return out


def _bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _salted(df: DataFrame, hot: DataFrame | None, keys: list[str], own: str, other: str) -> DataFrame:
    """Rows dealt over the salts of their own side and repeated over those of the other.

    ``hot`` holds ``_own`` and ``_other`` salt counts by key; other keys have one salt.
    """
    if hot is None:
        return df.withColumns({own: F.lit(0), other: F.lit(0)})
    mine, theirs = F.coalesce("_own", F.lit(1)), F.coalesce("_other", F.lit(1))
    deal = F.pmod(F.xxhash64(*df.columns), mine).cast("int").alias(own)
    repeat = F.explode(F.sequence(F.lit(0), theirs - 1)).alias(other)
    return df.join(F.broadcast(hot), keys, "left").select(*df.columns, deal, repeat)


def skew_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, min_rows: int = 1_000_000
) -> DataFrame:
    """Equi-join on ``keys`` with SQL ``=`` semantics (null matches nothing).

    Rows of a key that is hot on either side are dealt over several salts by a hash of
    the row, and the other side's rows of that key repeated once per salt, so every pair
    meets exactly once; left rows with a null key are scattered. A key hot on the right
    has a match for each of its left rows, so there a left join is an inner one. Semi and
    anti joins need each right key once only. Identical copies share a salt; adaptive
    execution splits those by map task.
    """
    if how not in HOW:
        raise ValueError(f"unsupported join type {how!r}")
    right = right.filter(~any_null(keys))
    one_sided = how in ("left_semi", "left_anti")
    if one_sided:
        right = right.select(*keys).distinct()
    sides = [left.select(*keys).filter(~any_null(keys)), right.select(*keys)]
    hot_left, hot_right = [*hot_keys(sides[: 1 if one_sided else 2], keys, min_rows), None][:2]
    if hot_right is not None:
        # Both sides' salts of the keys that are hot on the right: a grid, and an inner join.
        grid = hot_right.withColumnRenamed("_salts", "_right")
        if hot_left is not None:
            grid = grid.join(hot_left.withColumnRenamed("_salts", "_left"), keys, "left")
        else:
            grid = grid.withColumn("_left", F.lit(1))
        grid = materialise_small(grid.withColumn("_left", F.coalesce("_left", F.lit(1))))
        names = F.broadcast(grid.select(*keys))
        ours = grid.select(*keys, F.col("_left").alias("_own"), F.col("_right").alias("_other"))
        theirs = grid.select(*keys, F.col("_right").alias("_own"), F.col("_left").alias("_other"))
        a = _salted(left.join(names, keys, "left_semi"), ours, keys, "_i", "_j")
        b = _salted(right.join(names, keys, "left_semi"), theirs, keys, "_j", "_i")
        crowded = a.join(b, [*keys, "_i", "_j"], "inner").drop("_i", "_j")
        left, right = (df.join(names, keys, "left_anti") for df in (left, right))
    scatter = scatter_nulls(keys, left.columns)
    own = None if hot_left is None else hot_left.select(*keys, F.col("_salts").alias("_own"), F.lit(1).alias("_other"))
    theirs = None if hot_left is None else hot_left.select(*keys, F.lit(1).alias("_own"), F.col("_salts").alias("_other"))
    dealt = _salted(left, own, keys, "_salt", "_one").drop("_one")
    dealt = dealt.withColumn("_salt", F.when(any_null(keys), scatter).otherwise(F.col("_salt")))
    repeated = _salted(right, theirs, keys, "_one", "_salt").drop("_one")
    rest = dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
    return rest if hot_right is None else rest.unionByName(crowded)


def materialise_small(df: DataFrame) -> DataFrame:
    """At most MAX_HOT rows as a local relation, so they are not computed in every join."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
