"""Duplicate finding and removal (AG14, AG15, SO1, SO2).

All are hash aggregates: map-side combine first, so a value that holds a third of all
rows is one row per map task by the time it is shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_values(df: DataFrame, col: str) -> DataFrame:
    """AG14: values occurring more than once, with their count."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def dedup_report(df: DataFrame, col: str) -> DataFrame:
    """AG15: totals of a dedup on one column.  The duplicated values themselves are the
    AG14 table (unbounded, so not folded into this one row)."""
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("distinct_records"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(F.col("n") > 1).alias("duplicated_values"),
    )


def distinct_rows(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """SO1: drop fully equal rows (then optionally sort, as at a sink)."""
    out = df.distinct()
    return out.orderBy(*order) if order else out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SO2."""
    return df.select(col).distinct()


def across_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """AG15 over several sources: (value, occurrences, n_sources, sources) of every value of
    one-column frames, as text so that sources of different types meet; NULLs count for nothing.
    Combined map-side by (value, source) first, so a hot value is a row a task and source."""
    def one(name, df):
        return df.select(F.col(df.columns[0]).cast("string").alias("value"), F.lit(name).alias("source"))
    rows = reduce(DataFrame.unionByName, [one(name, df) for name, df in sources.items()]).where("value IS NOT NULL")
    per_source = rows.groupBy("value", "source").agg(F.count("*").alias("n"))
    return per_source.groupBy("value").agg(F.sum("n").alias("occurrences"), F.count("*").alias("n_sources"),
                                           F.array_sort(F.collect_list("source")).alias("sources"))


def across_sources_report(found: DataFrame) -> DataFrame:
    """Totals of a clean-up over sources: records, distinct values, records removed, and the values that
    more than one source has."""
    return found.agg(F.sum("occurrences").alias("total_records"), F.count("*").alias("distinct_records"),
                     (F.sum("occurrences") - F.count("*")).alias("duplicates_removed"), F.count_if(F.col("n_sources") > 1).alias("shared_values"))
