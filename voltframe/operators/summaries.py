"""Batch summaries (AG5, AG6, AG7, PF7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.numeric import round_to


def batch_metadata(enriched: DataFrame, nested: bool = False) -> DataFrame:
    """AG5: one-row metadata of an enriched batch (flat columns), from one row for each (zone,
    hour), so the distinct counts multiply that table and not the readings.  The
    sorted zone list is a set of distinct zones per task (bounded by the zone
    dimension, a few hundred ids), merged once.  ``nested`` groups the columns as the
    reference's metadata document (time_range, data_quality, price_summary)."""
    hours = enriched.groupBy("location_id", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
        F.sum("data_completeness_hourly").alias("c_sum"), F.count("data_completeness_hourly").alias("c_n"),
        F.min("data_completeness_hourly").alias("c_min"), F.count_if("is_complete_hour").alias("complete"),
        F.sum("lmp_total").alias("p_sum"), F.count("lmp_total").alias("p_n"), F.min("lmp_total").alias("p_min"),
        F.max("lmp_total").alias("p_max"), F.max("has_congestion").alias("congested"))
    flat = hours.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.count_distinct("location_id").alias("unique_locations"),
        F.min("t0").alias("time_start"),
        F.max("t1").alias("time_end"),
        round_to(F.try_divide(F.sum("c_sum"), F.sum("c_n")), 4).alias("avg_completeness"),
        F.min("c_min").alias("min_completeness"),
        F.coalesce(F.sum("complete"), F.lit(0)).alias("complete_hours"),      # rows, as the reference sums
        F.count_distinct("hour").alias("total_hours"),
        round_to(F.try_divide(F.sum("p_sum"), F.sum("p_n")), 4).alias("avg_lmp"),
        F.min("p_min").alias("min_lmp"),
        F.max("p_max").alias("max_lmp"),
        F.count_distinct(F.when(F.col("congested"), F.col("location_id"))).alias("zones_with_congestion"),
        F.array_join(F.array_sort(F.collect_set("location_id")), ",").alias("locations"),
    )
    if not nested:
        return flat
    return flat.select(
        "record_count", F.col("unique_locations"),
        F.split(F.col("locations"), ",").alias("locations"),
        F.struct(F.col("time_start").alias("start"), F.col("time_end").alias("end")).alias("time_range"),
        F.struct(F.col("avg_completeness"), F.col("min_completeness"), F.col("complete_hours"),
                 F.col("total_hours")).alias("data_quality"),
        F.struct(F.col("avg_lmp"), F.col("min_lmp"), F.col("max_lmp"),
                 F.col("zones_with_congestion")).alias("price_summary"))


def processing_summary(enriched: DataFrame, nested: bool = False) -> DataFrame:
    """AG6: status, counts, range, mean price by zone (map, 2 digits), completeness and
    congestion counts.  Two aggregate levels: per zone (distributed, map-side
    combined), then one row from the zone partials (one entry per zone).  ``nested``
    groups the columns as the reference's summary document."""
    per_zone = enriched.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lmp_total").alias("p_sum"), F.count("lmp_total").alias("p_n"),
        F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
        F.sum("data_completeness_hourly").alias("c_sum"), F.count("data_completeness_hourly").alias("c_n"),
        F.min("data_completeness_hourly").alias("c_min"), F.count_if("has_congestion").alias("cong"))
    zone_avg = round_to(F.try_divide(F.col("p_sum"), F.col("p_n")), 2)
    out = per_zone.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.count("location_id").alias("unique_locations"),
        F.min("t0").alias("start_time"),
        F.max("t1").alias("end_time"),
        round_to(F.try_divide(F.sum("c_sum"), F.sum("c_n")), 4).alias("avg_completeness"),
        F.min("c_min").alias("min_completeness"),
        F.coalesce(F.sum("cong"), F.lit(0)).alias("intervals_with_congestion"),
        F.count(F.when((F.col("cong") > 0) & F.col("location_id").isNotNull(), 1)).alias("zones_with_congestion"),
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("location_id").isNotNull(), F.struct("location_id", zone_avg.alias("avg_lmp"))))))
        .alias("avg_lmp_by_zone"))
    out = out.withColumn("status", F.when(F.col("record_count") == 0, "empty_dataframe").otherwise("success"))
    if not nested:
        return out
    return out.select(
        "status", "record_count", "unique_locations",
        F.struct(F.col("start_time").alias("start"), F.col("end_time").alias("end")).alias("date_range"),
        "avg_lmp_by_zone",
        F.struct(F.col("avg_completeness").alias("avg"), F.col("min_completeness").alias("min"))
        .alias("data_completeness"),
        F.struct("intervals_with_congestion", "zones_with_congestion").alias("congestion_summary"))


def load_weighted_average(df: DataFrame, price: str = "lmp_total", load: str = "load",
                          by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """AG7: sum(price * load) / sum(load); the denominator keeps rows whose price is
    NULL, as the reference's pandas sums do.  Zero load -> NULL."""
    p, w = F.col(price).cast("double"), F.col(load).cast("double")
    agg = round_to(F.try_divide(F.sum(p * w), F.sum(w)), digits).alias("load_weighted_price")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)
