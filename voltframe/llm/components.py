"""Connected components of a link table: large-star and small-star rounds over DataFrames.

Each round points the neighbours of a node at the smallest node around it; the number of rounds
grows with the logarithm of the longest chain.  Both minima are pre-aggregated before their
shuffle, so a node with very many links is no hot spot, and the skewed join of its links is
split by adaptive execution.  Every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import stage, unstage


def _star(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``links`` has long columns a and b.  Returns node, root (the smallest node reachable)
    for every node that a link to another node has.  Links may repeat; those of a node to
    itself, and null ends, are ignored.  An empty table gives an empty table."""
    def tidy(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = stage(tidy(links), "links")
    seen, new = None, mark(now)
    while new != seen and new[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both, least).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        mid = stage(tidy(large), "large-star")
        down = mid.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(down, least).select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        nxt = stage(tidy(small), "small-star")
        for old in (now, mid):
            unstage(old)
        now, seen, new = nxt, new, mark(nxt)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
