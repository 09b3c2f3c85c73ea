"""Hourly statistics (AG1), join-back (JN1), overall means (AG2), and the statistics that the
enrichment plan attaches to every reading (AG1 + WN1 + WN2) as windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.numeric import round_to
from voltframe.functions.timefields import floor_hour
from voltframe.operators.common import join_small, materialize
from voltframe.schemas import PRICE_COLUMNS

HOURLY_KEYS = ["location_id", "hour"]
STAT_DIGITS = 4


def with_hour(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df if "hour" in df.columns else df.withColumn("hour", floor_hour(df, ts))


def _stat_aggs(cols: list[str], digits: int = STAT_DIGITS) -> list:
    out = []
    for c in cols:
        out += [
            round_to(F.avg(c), digits).alias(f"{c}_mean_hourly"),
            round_to(F.min(c), digits).alias(f"{c}_min_hourly"),
            round_to(F.max(c), digits).alias(f"{c}_max_hourly"),
            round_to(F.stddev_samp(c), digits).alias(f"{c}_std_hourly"),
            F.count(c).alias(f"{c}_count_hourly"),
        ]
    return out


def hourly_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AG1: mean/min/max/sample std/count of each price column per (zone, hour),
    rounded to 4 digits; columns ``<col>_<stat>_hourly``."""
    cols = cols or PRICE_COLUMNS
    return with_hour(df).groupBy(*HOURLY_KEYS).agg(*_stat_aggs(cols))


def join_back(df: DataFrame, stats: DataFrame) -> DataFrame:
    """JN1: left equi-join of the per-hour statistics onto every reading."""
    return join_small(with_hour(df), materialize(stats), HOURLY_KEYS, "left")


def overall_hourly_means(stats_with_rows: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AG2: the row-weighted mean of each hourly mean (what averaging the joined-back
    column gives), computed on the compact per-hour table with weight ``_rows``."""
    cols = cols or PRICE_COLUMNS
    aggs = []
    for c in cols:
        m = F.col(f"{c}_mean_hourly")
        w = F.when(m.isNotNull(), F.col("_rows"))
        aggs.append(round_to(F.try_divide(F.sum(m * F.col("_rows")), F.sum(w)), STAT_DIGITS)
                    .alias(f"{c}_overall_mean"))
    return stats_with_rows.agg(*aggs)


def hourly_with_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AG1 columns plus ``_rows``, the readings of each (zone, hour)."""
    return with_hour(df).groupBy(*HOURLY_KEYS).agg(*_stat_aggs(cols or PRICE_COLUMNS), F.count(F.lit(1)).alias("_rows"))


def attach_statistics(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AG1 + JN1, WN1 and WN2 on every reading: the hourly statistics, ``_daily_avg`` (zone and
    date) and ``_system_avg`` (timestamp).  Windows keyed (zone, date, hour) and (zone, date)
    share one exchange on (zone, date); the mean by timestamp takes one more.  Neither depends on
    the size of a statistics table, and a group is a zone's day or one instant's zones.
    Readings without a zone or a time belong to no group and get NULLs.  Needs ``date``."""
    df = with_hour(df).repartition("location_id", "date")
    by_hour, by_day = Window.partitionBy("location_id", "date", "hour"), Window.partitionBy("location_id", "date")
    known = F.col("location_id").isNotNull() & F.col("hour").isNotNull()
    stats = {}
    for c in cols or PRICE_COLUMNS:
        stats |= {f"{c}_mean_hourly": round_to(F.avg(c).over(by_hour), STAT_DIGITS), f"{c}_min_hourly": round_to(F.min(c).over(by_hour), STAT_DIGITS),
                  f"{c}_max_hourly": round_to(F.max(c).over(by_hour), STAT_DIGITS),
                  f"{c}_std_hourly": round_to(F.stddev_samp(c).over(by_hour), STAT_DIGITS), f"{c}_count_hourly": F.count(c).over(by_hour)}
    stats["_daily_avg"] = F.avg("lmp_total").over(by_day)
    df = df.withColumns({name: F.when(known, value) for name, value in stats.items()})
    return df.withColumn("_system_avg", F.when(F.col("timestamp").isNotNull(), F.avg("lmp_total").over(Window.partitionBy("timestamp"))))
