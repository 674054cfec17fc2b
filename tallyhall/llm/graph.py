"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import materialise

MAX_ROUNDS = 60  # each round at least halves the depth; reached only if something is wrong


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node point to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, point to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node points to one smaller node that points to none: stars, nothing to do."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every node with a link; a component is its smallest id.

    Links are pairs of longs in any order; self-links, repeats and nulls don't matter.
    Each round is written to the shared folder, so a lost executor costs one round.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    pairs = pairs.filter("a is not null and b is not null and a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(pairs, "links")
    for _ in range(MAX_ROUNDS):
        if _settled(now):
            break
        now = materialise(_small(_large(now)), "stars")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
