"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node next to them: larger ones, or smaller ones and itself."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = (links.union(turned) if large else turned).select(F.col("a").alias("node"), F.col("b").alias("next"))
    least = around.groupBy("node").agg(F.min("next").alias("least"))
    least = least.select("node", F.least("node", "least").alias("root"))
    moved = around.join(least, "node")
    if large:
        moved = moved.filter("next > node").select(F.col("root").alias("a"), F.col("next").alias("b"))
    else:
        moved = moved.select(F.col("root").alias("a"), F.col("next").alias("b")).union(
            least.select(F.col("root").alias("a"), F.col("node").alias("b"))
        )
    return moved.filter("a < b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `links` (`a`, `b`): root is the smallest node reachable.

    Links are undirected; loops and repeats are harmless. Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the longest chain. Aggregates combine before the
    shuffle and the joins leave hubs to the split of skewed partitions.
    """
    now = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stored(now.filter("a < b").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(row)

    before, after = None, state(now)
    while after != before and after[0]:
        now = stored(_star(_star(now, True), False), "stars")
        before, after = after, state(now)
    inner = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return inner.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
