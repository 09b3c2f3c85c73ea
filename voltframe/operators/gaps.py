"""Gap detection and backfill list (JN5, DT17).

The expected grid is generated, not cross-joined: each (zone, day) row is one
``explode`` of that day's intervals, so generation is spread over tasks by
(zone, day).  The grid is anti-joined to the distinct present keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.timefields import floor_to_seconds, yyyymmdd
from voltframe.operators.common import materialize


def missing_days(df: DataFrame, ts: str = "timestamp", zone: str = "location_id",
                 interval_minutes: int = 15) -> DataFrame:
    """JN5 by day: (zone, day, missing), the intervals of a zone's day with no reading, for
    days that miss any.

    Per (zone, day): the set of grid-aligned timestamps present -- at most one day's
    worth of intervals (96 at 15 minutes), a proven bound, combined map-side so a hot
    zone-day costs one small set per task -- then ``array_except`` against the day's
    generated intervals.  The readings are read once, into that table; zones and calendar
    bounds come from it.  Days with no reading at all come from the (zone x day) calendar."""
    ntz = dict(df.dtypes)[ts] == "timestamp_ntz"
    ttype = "timestamp_ntz" if ntz else "timestamp"
    step = F.expr(f"INTERVAL {interval_minutes} MINUTES")
    rows = df.select(zone, ts).filter(F.col(ts).isNotNull())
    on_grid = F.when(F.col(ts) == floor_to_seconds(rows, ts, interval_minutes * 60), F.col(ts))
    present = materialize(rows.groupBy(zone, F.to_date(ts).alias("day")).agg(F.collect_set(on_grid).alias("_present")))
    bounds = present.agg(F.min("day").alias("d0"), F.max("day").alias("d1")).first()
    if bounds["d0"] is None:
        return present.select(zone, "day", F.col("_present").alias("missing"))
    zones = present.select(zone).filter(F.col(zone).isNotNull()).distinct()
    calendar = zones.select(zone, F.explode(F.sequence(F.lit(bounds["d0"]), F.lit(bounds["d1"]),
                                                       F.expr("INTERVAL 1 DAY"))).alias("day"))
    days = calendar.join(present, [zone, "day"], "left")
    start = F.col("day").cast(ttype)
    grid = F.sequence(start, start + F.expr(f"INTERVAL {24 * 60 - interval_minutes} MINUTES"), step)
    missing = F.array_except(grid, F.coalesce(F.col("_present"), F.array().cast(f"array<{ttype}>")))
    return days.select(zone, "day", missing.alias("missing")).filter(F.size("missing") > 0)


def missing_intervals(df: DataFrame, ts: str = "timestamp", zone: str = "location_id",
                      interval_minutes: int = 15) -> DataFrame:
    """JN5: (zone, interval) pairs with no reading."""
    return missing_days(df, ts, zone, interval_minutes).select(zone, F.explode("missing").alias(ts))


def missing_runs(days: DataFrame, zone: str = "location_id", interval_minutes: int = 15) -> DataFrame:
    """JN5 as runs: (zone, first, last, intervals) of each stretch of missing intervals, over
    midnights too, from ``missing_days``.

    A day's runs come from its own set of intervals (96 at most) without a shuffle.  Only a run that
    touches midnight can go on, so a zone's days are looked at in order, one row a day: a
    day's last run and the next day's first are one if both touch the midnight between them."""
    step = F.expr(f"INTERVAL {interval_minutes} MINUTES")
    slots = F.array_sort("missing")
    runs = F.aggregate(slots, F.array().cast(f"array<struct<first:{_slot_type(days)},last:{_slot_type(days)},intervals:bigint>>"), lambda acc, t: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["last"] + step == t),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["first"].alias("first"), t.alias("last"), (F.try_element_at(acc, F.lit(-1))["intervals"] + 1).alias("intervals")))))
        .otherwise(F.concat(acc, F.array(F.struct(t.alias("first"), t.alias("last"), F.lit(1).cast("long").alias("intervals"))))))
    each = days.select(zone, "day", F.posexplode(runs).alias("nth", "run")).select(zone, "day", "nth", "run.*")
    midnight = F.col("day").cast(_slot_type(days))
    from_start, to_end = F.col("first") == midnight, F.col("last") + step == midnight + F.expr("INTERVAL 24 HOURS")
    # rows that touch a midnight, two a day at most
    edge = each.where(from_start | to_end)
    order = Window.partitionBy(zone).orderBy("first")
    goes_on = F.lag("last").over(order) + step == F.col("first")
    edge = edge.withColumn("begins", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    edge = edge.withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edge.groupBy(zone, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("intervals").alias("intervals")).drop("run")
    inner = each.where(~(from_start | to_end)).select(zone, "first", "last", "intervals")
    return inner.unionByName(joined)


def _slot_type(days: DataFrame) -> str:
    return days.schema["missing"].dataType.elementType.simpleString()


def fill_url_template(template: Column, params: Column) -> Column:
    """Replace every ``{key}`` placeholder of a URL template with its value from a
    map column (the reference's URL parameter rule), as one higher-order expression."""
    return F.aggregate(F.map_entries(params), template,
                       lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")),
                                                e["value"].cast("string")))


def backfill_urls(days: DataFrame, url_template: str) -> DataFrame:
    """Days with missing intervals per zone (``missing_days``), their number, and the pull URL
    for that day (``{day}`` in the template becomes yyyyMMdd)."""
    params = F.create_map(F.lit("day"), yyyymmdd(F.col("day")))
    return days.withColumn("missing_intervals", F.size("missing").cast("long")).drop("missing").withColumn(
        "url", fill_url_template(F.lit(url_template), params))
