"""Approximate statistics as stored, mergeable sketches (AG8, AG13, AG15).

A sketch table has one row for each group and day (or source).  Months, trailing windows and unions are
merged from it: the rows are read once, when their day arrives, and never again.  Quantiles are KLL
sketches of ``K`` (a rank is off by about 2.296 / K^0.9723 of the rows at 99 %), distinct counts
HyperLogLog sketches of 2^``LG`` cells (off by about 1.04 / 2^(LG/2)).  Both have a size that doesn't
grow with the rows, and are built map-side, so a hot group costs one sketch a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, LG = 800, 12


def rank_error(k: int = K) -> float:
    """Share of the rows by which a quantile's rank may be off, at 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int = LG) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg / 2)


def daily_quantile_sketches(df: DataFrame, value: str, ts: str, by: list[str] | None = None, k: int = K) -> DataFrame:
    """(by..., day, n, sketch) of the values that are not NULL; rows without a time have the NULL day."""
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*(by or []), F.to_date(ts).alias("day"), v.alias("_value"))
    return rows.groupBy(*(by or []), "day").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_value", F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], quantiles: dict[str, float]) -> DataFrame:
    """(by..., n, one column for each quantile) of sketches merged by group."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*by, "n", *(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in quantiles.items()))


def trailing_windows(sketches: DataFrame, days: int, by: list[str] | None = None) -> DataFrame:
    """Each day's sketch for each window of ``days`` days that it is in; ``day`` becomes the window's
    last day.  Windows end on days that have rows."""
    ends = sketches.select(*(by or []), F.col("day").alias("_end")).distinct()
    reach = F.sequence("day", F.date_add("day", days - 1), F.expr("INTERVAL 1 DAY"))
    spread = sketches.where("day IS NOT NULL").withColumn("_end", F.explode(reach))
    return spread.join(ends, [*(by or []), "_end"], "left_semi").drop("day").withColumnRenamed("_end", "day")


def rank_bounds(rows: DataFrame, estimates: DataFrame, by: list[str], value: str, quantiles: dict[str, float], error: float) -> DataFrame:
    """For each group and quantile, whether the estimate's true rank among the rows is within
    ``error`` of the rows: (by..., p, n, within)."""
    from voltframe.operators.common import join_small, materialize

    asked = F.array(*(F.struct(F.lit(float(p)).alias("p"), F.col(name).alias("cut")) for name, p in quantiles.items()))
    cuts = materialize(estimates.select(*by, F.explode(asked).alias("q")).select(*by, "q.*"))
    v = F.col(value).cast("double")
    ranks = join_small(rows.where(v.isNotNull()).select(*by, v.alias("_value")), cuts, by, "inner").groupBy(*by, "p").agg(
        F.count("*").alias("n"), F.count_if(F.col("_value") < F.col("cut")).alias("below"), F.count_if(F.col("_value") <= F.col("cut")).alias("upto"))
    within = (F.col("below") / F.col("n") - error <= F.col("p")) & (F.col("p") <= F.col("upto") / F.col("n") + error)
    return ranks.select(*by, "p", "n", within.alias("within"))


def distinct_sketches(sources: dict[str, DataFrame], lg: int = LG) -> DataFrame:
    """(source, sketch) of one-column frames; NULLs count for nothing."""
    def one(name, df):
        return df.agg(F.hll_sketch_agg(F.col(df.columns[0]).cast("string"), F.lit(lg)).alias("sketch")).select(F.lit(name).alias("source"), "sketch")
    return reduce(DataFrame.unionByName, [one(name, df) for name, df in sources.items()])


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(first, second, distinct, overlap) for each source (first = second) and each two of them: the
    distinct values of both together, and those in both (inclusion and exclusion).  The table has
    one row a source, so the pairs are the sources' and not the rows'."""
    every = sketches.agg(F.collect_list(F.struct("source", "sketch")).alias("s"))
    pair = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: a["source"] <= b["source"]), lambda b: F.struct(
        a["source"].alias("first"), b["source"].alias("second"), a["sketch"].alias("_a"), b["sketch"].alias("_b")))))
    pairs = every.select(F.explode(pair).alias("p")).select("p.*")
    size = {c: F.hll_sketch_estimate(c) for c in ("_a", "_b")}
    both = F.hll_sketch_estimate(F.hll_union("_a", "_b"))
    return pairs.select("first", "second", both.alias("distinct"), F.when(F.col("first") == F.col("second"), size["_a"]).otherwise(size["_a"] + size["_b"] - both).alias("overlap"))
