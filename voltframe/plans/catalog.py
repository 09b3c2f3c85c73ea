"""Registered queries over the driver tables, with their DuckDB oracles.

Every query reads whole tables (no id subsets, no row caps); the only limits are
features (the top-5 outlier sample).  ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
``ORACLE[name] -> SQL``; queries without an SQL equivalent have no ORACLE entry.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions import formats as FM
from voltframe.functions import semistructured as SS
from voltframe.functions.timefields import add_time_fields
from voltframe.operators.anomaly import flag_anomalies
from voltframe.operators.audit import (
    SOURCE_CATALOGUE, ingest_audit, resolve_sources, select_sources, selective_summary,
)
from voltframe.operators.clean import cleaning_report, coerce_prices, dedup_first
from voltframe.operators.duplicates import dedup_report, distinct_rows, distinct_values, duplicate_values
from voltframe.operators.gaps import backfill_urls, missing_days, missing_intervals
from voltframe.operators.hourly import hourly_stats, hourly_with_rows, join_back, overall_hourly_means
from voltframe.operators.summaries import batch_metadata, load_weighted_average, processing_summary
from voltframe.operators.validate import batch_verdict, outlier_flag, outlier_sample
from voltframe.plans import kwh as KW
from voltframe.plans import oracle_sql as O
from voltframe.plans.enrich import enrich_readings, thin_zones, zone_completeness
from voltframe.session import scratch_path
from voltframe.sinks import writers as W
from voltframe.sources.adapters import (
    DIRTY_READINGS_SQL, EVENT_TYPE_ZONE, TEXT_READINGS_SQL, dirty_readings_from_events, load_kwh, load_readings,
    readings_from_events, text_readings_from_events, zone_coded_readings_from_events,
)
from voltframe.sources.files import read_back
from voltframe.sources.genmix import genmix_records, transform_kwh
from voltframe.sources.tables import load_table
from voltframe.sources.zones import ZONES, enrich_with_zones
from voltframe.streaming.ingest import dedup_stream, hourly_stream, read_landing_stream, run_available_now

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TIE_ORDER = ["extraction_time", "event_id"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _deduped(spark: SparkSession, sf_dir: str):
    """What AG3 and AG4 take of the cleaned readings."""
    rows = load_readings(spark, sf_dir).select("timestamp", "location_id", "lmp_total", *TIE_ORDER)
    return dedup_first(rows, ["timestamp", "location_id"], TIE_ORDER)


def _enriched(spark: SparkSession, sf_dir: str):
    return enrich_readings(load_readings(spark, sf_dir), order=TIE_ORDER)


# ---------------------------------------------------------------- AG1, JN1, AG2, WN4, DT
HOURLY_RAW = f"h AS (SELECT location_id, hour, {O.hourly_aggs()} FROM (SELECT *, date_trunc('hour', timestamp) AS hour FROM r) GROUP BY location_id, hour)"


@register("hourly_stats", O.with_(O.R, HOURLY_RAW) + "SELECT * FROM h")
def q_hourly_stats(spark, sf_dir):
    return hourly_stats(load_readings(spark, sf_dir))


@register("hourly_join_back", O.with_(O.R, HOURLY_RAW) +
          "SELECT r.*, h.* EXCLUDE (location_id, hour) FROM "
          "(SELECT *, date_trunc('hour', timestamp) AS hour FROM r) r LEFT JOIN h USING (location_id, hour)")
def q_hourly_join_back(spark, sf_dir):
    readings = load_readings(spark, sf_dir)
    return join_back(readings, hourly_stats(readings))


_OVERALL = ", ".join(f"{O.rnd(f'avg({c}_mean_hourly)', 4)} AS {c}_overall_mean" for c in O.PRICES)


@register("hourly_overall_mean", O.with_(O.R, HOURLY_RAW) +
          f"SELECT {_OVERALL} FROM (SELECT *, date_trunc('hour', timestamp) AS hour FROM r) r "
          "LEFT JOIN h USING (location_id, hour)")
def q_hourly_overall_mean(spark, sf_dir):
    return overall_hourly_means(hourly_with_rows(load_readings(spark, sf_dir)))


@register("dedup_first", O.with_(O.R, O.D) + "SELECT * FROM d")
def q_dedup_first(spark, sf_dir):
    return dedup_first(load_readings(spark, sf_dir), ["timestamp", "location_id"], TIE_ORDER)


_TIME_OUT = ("timestamp, location_id, event_id, date, hour_of_day, minute_of_hour, day_of_week, day_of_year, "
             "week_of_year, month, quarter, year, hour, is_weekend, is_peak_hour, is_business_hour, season, "
             "time_period")


@register("time_fields", O.with_(O.R, "c AS (SELECT * FROM r)", O.T0, O.T) + f"SELECT {_TIME_OUT} FROM t")
def q_time_fields(spark, sf_dir):
    return add_time_fields(load_readings(spark, sf_dir)).select(*[c.strip() for c in _TIME_OUT.split(",")])


# ---------------------------------------------------------------- PL1 and its projections
@register("enriched_readings", O.with_(*O.READING_CHAIN) + "SELECT * FROM e")
def q_enriched_readings(spark, sf_dir):
    return _enriched(spark, sf_dir).readings


_DERIVED_OUT = ("timestamp, location_id, lmp_volatility_hourly, is_high_volatility, has_congestion, "
                "congestion_level, loss_percentage, data_completeness_hourly, is_complete_hour")


@register("derived_fields", O.with_(*O.READING_CHAIN) + f"SELECT {_DERIVED_OUT} FROM e")
def q_derived_fields(spark, sf_dir):
    return _enriched(spark, sf_dir).readings.select(*[c.strip() for c in _DERIVED_OUT.split(",")])


@register("vs_daily_avg", O.with_(*O.READING_CHAIN) +
          "SELECT timestamp, location_id, date, lmp_total, price_vs_daily_avg FROM e")
def q_vs_daily_avg(spark, sf_dir):
    return _enriched(spark, sf_dir).readings.select("timestamp", "location_id", "date", "lmp_total",
                                                    "price_vs_daily_avg")


@register("vs_system_avg", O.with_(*O.READING_CHAIN) +
          "SELECT timestamp, location_id, lmp_total, price_vs_system_avg FROM e")
def q_vs_system_avg(spark, sf_dir):
    return _enriched(spark, sf_dir).readings.select("timestamp", "location_id", "lmp_total",
                                                    "price_vs_system_avg")


@register("zone_completeness", O.with_(*O.READING_CHAIN) +
          f"SELECT location_id, {O.rnd('avg(data_completeness_hourly)', 4)} AS avg_completeness, "
          "count(timestamp) AS record_count, coalesce(avg(data_completeness_hourly) < 80, false) AS is_low_completeness "
          "FROM e GROUP BY location_id")
def q_zone_completeness(spark, sf_dir):
    return zone_completeness(_deduped(spark, sf_dir))


@register("thin_zone", O.with_(*O.READING_CHAIN) +
          "SELECT min(n) AS min_records, count(*) AS zones, min(n) < 80 AS has_thin_zone "
          "FROM (SELECT location_id, count(timestamp) AS n FROM e GROUP BY location_id)")
def q_thin_zone(spark, sf_dir):
    return thin_zones(_deduped(spark, sf_dir))


# ---------------------------------------------------------------- validation and cleaning
def _dirty(spark, sf_dir):
    return dirty_readings_from_events(load_table(spark, sf_dir, "events"))


def _text(spark, sf_dir):
    return text_readings_from_events(load_table(spark, sf_dir, "events"))


RD = f"r AS ({DIRTY_READINGS_SQL})"
RT = f"r AS ({TEXT_READINGS_SQL})"
_NULLS = "count(CASE WHEN timestamp IS NULL THEN 1 END) + count(CASE WHEN location_id IS NULL THEN 1 END) + count(CASE WHEN lmp_total IS NULL THEN 1 END)"


@register("batch_verdict", O.with_(RD) +
          "SELECT count(*) AS row_count, count(CASE WHEN timestamp IS NULL THEN 1 END) AS null_timestamp, "
          "count(CASE WHEN location_id IS NULL THEN 1 END) AS null_location_id, count(CASE WHEN lmp_total IS NULL THEN 1 END) AS null_lmp_total, "
          "count(CASE WHEN NOT coalesce(lmp_total BETWEEN -1000 AND 1000, false) THEN 1 END) AS outlier_count, "
          f"CAST(0 AS BIGINT) AS rejected_times, '' AS missing_columns, ({_NULLS}) = 0 AS is_valid, count(*) = 0 AS is_empty FROM r")
def q_batch_verdict(spark, sf_dir):
    return batch_verdict(_dirty(spark, sf_dir))


@register("outlier_flags", O.with_(RD) +
          "SELECT timestamp, location_id, event_id, lmp_total, "
          "NOT coalesce(lmp_total BETWEEN -1000 AND 1000, false) AS is_outlier FROM r")
def q_outlier_flags(spark, sf_dir):
    return outlier_flag(_dirty(spark, sf_dir)).select("timestamp", "location_id", "event_id", "lmp_total",
                                                      "is_outlier")


@register("outlier_top5", O.with_(RD) +
          "SELECT timestamp, location_id, lmp_total FROM r "
          "WHERE NOT coalesce(lmp_total BETWEEN -1000 AND 1000, false) "
          "ORDER BY timestamp NULLS FIRST, location_id NULLS FIRST, lmp_total NULLS FIRST LIMIT 5")
def q_outlier_top5(spark, sf_dir):
    return outlier_sample(_dirty(spark, sf_dir))


_COERCE = ", ".join(f"coalesce(TRY_CAST(trim({c}) AS DOUBLE), 0.0) AS {c}" for c in O.PRICES)


@register("clean_numeric", O.with_(RT) +
          f"SELECT timestamp, trim(location_id) AS location_id, event_id, {_COERCE} FROM r")
def q_clean_numeric(spark, sf_dir):
    return coerce_prices(_text(spark, sf_dir)).select("timestamp", "location_id", "event_id", *O.PRICES)


_REPORT = ", ".join(
    [f"count(CASE WHEN {c} IS NOT NULL AND TRY_CAST(trim({c}) AS DOUBLE) IS NULL THEN 1 END) AS {c}_coerced" for c in O.PRICES]
    + [f"count(CASE WHEN TRY_CAST(trim({c}) AS DOUBLE) IS NULL THEN 1 END) AS {c}_filled" for c in O.PRICES])


@register("cleaning_report", O.with_(RT, O.D) +
          f"SELECT {_REPORT}, count(*) AS output_rows, (SELECT count(*) FROM r) AS input_rows, "
          "(SELECT count(*) FROM r) - count(*) AS duplicates_removed, CAST(0 AS BIGINT) AS rejected_times FROM d")
def q_cleaning_report(spark, sf_dir):
    return cleaning_report(_text(spark, sf_dir), TIE_ORDER)


# ---------------------------------------------------------------- summaries (AG5-AG7)
@register("batch_metadata", O.with_(*O.READING_CHAIN) +
          "SELECT count(*) AS record_count, count(DISTINCT location_id) AS unique_locations, "
          "min(timestamp) AS time_start, max(timestamp) AS time_end, "
          f"{O.rnd('avg(data_completeness_hourly)', 4)} AS avg_completeness, "
          "min(data_completeness_hourly) AS min_completeness, count(CASE WHEN is_complete_hour THEN 1 END) AS complete_hours, "
          f"count(DISTINCT hour) AS total_hours, {O.rnd('avg(lmp_total)', 4)} AS avg_lmp, "
          "min(lmp_total) AS min_lmp, max(lmp_total) AS max_lmp, "
          "count(DISTINCT CASE WHEN has_congestion THEN location_id END) AS zones_with_congestion, "
          "string_agg(DISTINCT location_id, ',' ORDER BY location_id) AS locations FROM e")
def q_batch_metadata(spark, sf_dir):
    return batch_metadata(_enriched(spark, sf_dir).readings)


@register("processing_summary", O.with_(*O.READING_CHAIN) +
          "SELECT o.*, z.* FROM (SELECT count(*) AS record_count, count(DISTINCT location_id) AS unique_locations, "
          "min(timestamp) AS start_time, max(timestamp) AS end_time, "
          f"{O.rnd('avg(data_completeness_hourly)', 4)} AS avg_completeness, "
          "min(data_completeness_hourly) AS min_completeness, count(CASE WHEN has_congestion THEN 1 END) AS intervals_with_congestion, "
          "count(DISTINCT CASE WHEN has_congestion THEN location_id END) AS zones_with_congestion, "
          "CASE WHEN count(*) = 0 THEN 'empty_dataframe' ELSE 'success' END AS status FROM e) o, "
          f"(SELECT location_id, {O.rnd('avg(lmp_total)', 2)} AS avg_lmp FROM e GROUP BY location_id) z")
def q_processing_summary(spark, sf_dir):
    s = processing_summary(_enriched(spark, sf_dir).readings)
    return s.select("*", F.explode("avg_lmp_by_zone").alias("location_id", "avg_lmp")).drop("avg_lmp_by_zone")


@register("load_weighted_price", O.with_(O.R) +
          f"SELECT location_id, {O.rnd('sum(lmp_total * load) / nullif(sum(CAST(load AS DOUBLE)), 0)', 4)} "
          "AS load_weighted_price FROM r GROUP BY location_id")
def q_load_weighted_price(spark, sf_dir):
    return load_weighted_average(load_readings(spark, sf_dir), by=["location_id"])


# ---------------------------------------------------------------- anomalies (MA12-MA14)
_ANOM_OUT = "event_id, timestamp, location_id, lmp_total"


def _anomaly(method):
    def run(spark, sf_dir):
        r = load_readings(spark, sf_dir).select(*[c.strip() for c in _ANOM_OUT.split(",")])
        return flag_anomalies(r, "lmp_total", method, 3.0)
    return run


register("anomaly_iqr", O.with_(O.R) +
         "SELECT r.event_id, r.timestamp, r.location_id, r.lmp_total, coalesce(r.lmp_total < s.q1 - 3.0 * (s.q3 - s.q1) "
         "OR r.lmp_total > s.q3 + 3.0 * (s.q3 - s.q1), false) AS is_anomaly FROM r, "
         "(SELECT quantile_cont(lmp_total, 0.25) AS q1, quantile_cont(lmp_total, 0.75) AS q3 FROM r) s")(_anomaly("iqr"))
register("anomaly_zscore", O.with_(O.R) +
         "SELECT r.event_id, r.timestamp, r.location_id, r.lmp_total, "
         "coalesce(abs((r.lmp_total - s.m) / nullif(s.sd, 0)) > 3.0, false) AS is_anomaly FROM r, "
         "(SELECT avg(lmp_total) AS m, stddev_samp(lmp_total) AS sd FROM r) s")(_anomaly("zscore"))
register("anomaly_mad", O.with_(O.R, "m AS (SELECT median(lmp_total) AS med FROM r)",
                                "a AS (SELECT median(abs(lmp_total - (SELECT med FROM m))) AS mad FROM r)") +
         "SELECT r.event_id, r.timestamp, r.location_id, r.lmp_total, coalesce(CASE WHEN a.mad = 0 "
         "THEN r.lmp_total <> m.med ELSE abs(0.6745 * (r.lmp_total - m.med) / a.mad) > 3.0 END, false) "
         "AS is_anomaly FROM r, m, a")(_anomaly("modified_zscore"))


# ---------------------------------------------------------------- kWh view and reports (PL3)

AS_OF = _dt.date(2024, 1, 31)


def _dec_as_double(df):
    """Present decimal outputs as doubles and dates as ISO text (the oracle casts the
    same way), so value hashes do not depend on how each engine hands them to Python."""
    from pyspark.sql import types as T

    def conv(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        return F.col(f.name)
    return df.select(*[conv(f) for f in df.schema.fields])
_ASOF_SQL = "DATE '2024-01-31'"
_DAY = "strftime(DateTime, '%Y-%m-%d')"


@register("kwh_view", O.with_(O.K) +
          f"SELECT DateTime, CAST(round(kWh, 1) AS DOUBLE) AS kWh_rounded, {_DAY} AS date_only, strftime(DateTime, '%H') AS hour_only, "
          "CASE WHEN strftime(DateTime, '%H') BETWEEN '06' AND '18' THEN 'Day' ELSE 'Night' END AS time_period "
          "FROM k WHERE DateTime IS NOT NULL")
def q_kwh_view(spark, sf_dir):
    return _dec_as_double(KW.kwh_view(load_kwh(spark, sf_dir)))


@register("kwh_daily", O.with_(O.K) +
          f"SELECT {_DAY} AS date, count(*) AS reading_count, {O.rnd('avg(CAST(kWh AS DOUBLE))', 4)} AS avg_kwh, "
          "CAST(min(kWh) AS DOUBLE) AS min_kwh, CAST(max(kWh) AS DOUBLE) AS max_kwh, CAST(sum(kWh) AS DOUBLE) AS total_kwh FROM k "
          f"WHERE DateTime >= {_ASOF_SQL} - INTERVAL 7 DAY GROUP BY {_DAY} ORDER BY date DESC")
def q_kwh_daily(spark, sf_dir):
    return _dec_as_double(KW.daily_summary(load_kwh(spark, sf_dir), AS_OF))


@register("kwh_hour_pattern", O.with_(O.K) +
          "SELECT strftime(DateTime, '%H') AS hour, count(*) AS reading_count, "
          f"{O.rnd('avg(CAST(kWh AS DOUBLE))', 4)} AS avg_kwh, {O.rnd('stddev_samp(CAST(kWh AS DOUBLE))', 4)} AS stddev_kwh "
          f"FROM k WHERE DateTime >= {_ASOF_SQL} - INTERVAL 30 DAY GROUP BY strftime(DateTime, '%H') ORDER BY hour")
def q_kwh_hour_pattern(spark, sf_dir):
    return KW.hour_pattern(load_kwh(spark, sf_dir), AS_OF)


@register("kwh_peaks", O.with_(O.K) +
          "SELECT DateTime, CAST(kWh AS DOUBLE) AS kWh, CAST(lag(kWh) OVER w AS DOUBLE) AS prev_kwh, "
          "CAST(lead(kWh) OVER w AS DOUBLE) AS next_kwh, "
          "CASE WHEN kWh > lag(kWh) OVER w AND kWh > lead(kWh) OVER w THEN 'Peak' ELSE 'Normal' END "
          f"AS consumption_type FROM k WHERE DateTime >= {_ASOF_SQL} - INTERVAL 7 DAY "
          "WINDOW w AS (ORDER BY DateTime, kWh) ORDER BY DateTime DESC")
def q_kwh_peaks(spark, sf_dir):
    return _dec_as_double(KW.peaks(load_kwh(spark, sf_dir), AS_OF))


_QUALITY = (f"SELECT {_DAY} AS date, count(*) AS total_records, "
            "count(CASE WHEN kWh IS NULL THEN 1 END) AS null_kwh_count, "
            "count(CASE WHEN kWh < 0 THEN 1 END) AS negative_kwh_count, "
            "count(CASE WHEN DateTime IS NULL THEN 1 END) AS null_datetime_count, "
            "min(DateTime) AS earliest_time, max(DateTime) AS latest_time FROM k ")


@register("kwh_quality", O.with_(O.K) + _QUALITY +
          f"WHERE DateTime >= {_ASOF_SQL} - INTERVAL 30 DAY GROUP BY {_DAY} ORDER BY date DESC")
def q_kwh_quality(spark, sf_dir):
    return KW.quality(load_kwh(spark, sf_dir), AS_OF)


@register("kwh_quality_all", O.with_(O.K) + _QUALITY + f"GROUP BY {_DAY} ORDER BY date DESC")
def q_kwh_quality_all(spark, sf_dir):
    return KW.quality_all(load_kwh(spark, sf_dir))


@register("kwh_monthly", O.with_(O.K) +
          "SELECT strftime(DateTime, '%Y-%m') AS month, count(*) AS reading_count, "
          f"{O.rnd('avg(CAST(kWh AS DOUBLE))', 4)} AS avg_kwh, CAST(sum(kWh) AS DOUBLE) AS total_kwh, "
          "CAST(min(kWh) AS DOUBLE) AS min_kwh, CAST(max(kWh) AS DOUBLE) AS max_kwh, "
          "CAST(quantile_disc(kWh, 0.5) AS DOUBLE) AS median_kwh, CAST(quantile_disc(kWh, 0.95) AS DOUBLE) AS p95_kwh FROM k "
          f"WHERE DateTime >= {_ASOF_SQL} - INTERVAL 12 MONTH GROUP BY strftime(DateTime, '%Y-%m') ORDER BY month DESC")
def q_kwh_monthly(spark, sf_dir):
    return _dec_as_double(KW.monthly_trend(load_kwh(spark, sf_dir), AS_OF, exact=True))


# ---------------------------------------------------------------- duplicates (AG14, AG15, SO1, SO2)


@register("duplicate_values",
          "SELECT l_partkey AS value, count(*) AS occurrences FROM lineitem GROUP BY l_partkey HAVING count(*) > 1")
def q_duplicate_values(spark, sf_dir):
    return duplicate_values(load_table(spark, sf_dir, "lineitem", ["l_partkey"]), "l_partkey")


@register("dedup_report",
          "SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS distinct_records, "
          "CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed, "
          "count(CASE WHEN n > 1 THEN 1 END) AS duplicated_values FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)")
def q_dedup_report(spark, sf_dir):
    return dedup_report(load_table(spark, sf_dir, "lineitem", ["l_partkey"]), "l_partkey")


@register("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def q_distinct_rows(spark, sf_dir):
    return distinct_rows(load_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey"]))


@register("distinct_values", "SELECT DISTINCT l_partkey FROM lineitem")
def q_distinct_values(spark, sf_dir):
    return distinct_values(load_table(spark, sf_dir, "lineitem", ["l_partkey"]), "l_partkey")


# ---------------------------------------------------------------- zones, gaps (JN4, JN5, DT17)

_ZONE_VALUES = ", ".join(f"({zid}, '{name}', '{code}')" for zid, name, code in ZONES if code)


@register("zone_enriched", O.with_(O.R) +
          "SELECT r.timestamp, r.location_id, r.event_id, r.lmp_total, z.zone_id, z.zone_name FROM r "
          f"LEFT JOIN (VALUES {_ZONE_VALUES}) z(zone_id, zone_name, location_code) ON r.location_id = z.location_code")
def q_zone_enriched(spark, sf_dir):
    r = load_readings(spark, sf_dir).select("timestamp", "location_id", "event_id", "lmp_total")
    return enrich_with_zones(r)


_GRID = ("z AS (SELECT DISTINCT location_id FROM r), "
         "b AS (SELECT CAST(CAST(min(timestamp) AS DATE) AS TIMESTAMP) AS t0, "
         "CAST(CAST(max(timestamp) AS DATE) AS TIMESTAMP) AS t1 FROM r), "
         "g AS (SELECT location_id, unnest(generate_series(t0, t1 + INTERVAL '23 hours 45 minutes', "
         "INTERVAL '15 minutes')) AS timestamp FROM z, b), "
         "m AS (SELECT * FROM g ANTI JOIN (SELECT DISTINCT location_id, timestamp FROM r) p "
         "USING (location_id, timestamp))")
BACKFILL_TEMPLATE = "https://example.invalid/morningreport/day/{day}"


@register("missing_intervals", O.with_(O.R, _GRID) + "SELECT location_id, timestamp FROM m")
def q_missing_intervals(spark, sf_dir):
    return missing_intervals(load_readings(spark, sf_dir))


@register("backfill_urls", O.with_(O.R, _GRID) +
          "SELECT location_id, strftime(CAST(timestamp AS DATE), '%Y-%m-%d') AS day, count(*) AS missing_intervals, "
          f"replace('{BACKFILL_TEMPLATE}', '{{day}}', strftime(CAST(timestamp AS DATE), '%Y%m%d')) AS url "
          "FROM m GROUP BY location_id, CAST(timestamp AS DATE)")
def q_backfill_urls(spark, sf_dir):
    return _dec_as_double(backfill_urls(missing_days(load_readings(spark, sf_dir)), BACKFILL_TEMPLATE))


# ---------------------------------------------------------------- generation mix (SRC3, MA16, PL2)


def genmix_payloads(events: DataFrame) -> DataFrame:
    """One nested payload per event: BeginDate missing on 'signup', GenMw missing on
    'error', the inner array missing on 'view', the row repeated on 'click'."""
    et = F.col("event_type")
    inner = F.struct(
        F.when(et != "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("BeginDate"),
        F.when(et != "error", F.col("value")).alias("GenMw"))
    arr = F.when(et == "view", F.lit(None)).when(et == "click", F.array(inner, inner)).otherwise(F.array(inner))
    return events.select(F.to_json(F.struct(F.array(F.struct(arr.alias("GenMixs"))).alias("GenMixes")))
                         .alias("payload"))


_GENMIX_ROWS = ("gm AS (SELECT CASE WHEN event_type = 'signup' THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END "
                "AS DateTime, (CASE WHEN event_type = 'error' THEN 0.0 ELSE value END) * 1000 AS kWh "
                "FROM events, (SELECT 1 AS rep UNION ALL SELECT 2) reps "
                "WHERE event_type <> 'view' AND (rep = 1 OR event_type = 'click'))")


@register("genmix_rows", O.with_(_GENMIX_ROWS) + "SELECT DateTime, kWh FROM gm")
def q_genmix_rows(spark, sf_dir):
    return genmix_records(genmix_payloads(load_table(spark, sf_dir, "events")))


@register("genmix_kwh", O.with_(_GENMIX_ROWS) +
          f"SELECT DISTINCT TRY_CAST(DateTime AS TIMESTAMP) AS DateTime, {O.rnd('kWh', 1)} AS kWh FROM gm")
def q_genmix_kwh(spark, sf_dir):
    return transform_kwh(genmix_records(genmix_payloads(load_table(spark, sf_dir, "events"))))


# ---------------------------------------------------------------- semi-structured (SF1-SF8, AG17, PF9)

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _contents(spark, sf_dir):
    pages = load_table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("path"),
        F.when(F.col("url").contains(".com/"), "text/html; charset=UTF-8")
         .when(F.col("url").contains(".org/"), "Application/JSON").alias("content_type"),
        F.col("html").alias("content"))
    docs = load_table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.col("source").alias("path"),
        F.lit(None).cast("string").alias("content_type"), F.col("text").alias("content"))
    return pages.unionByName(docs)


_CONTENTS_SQL = ("x AS (SELECT 'page' AS kind, page_id AS id, url AS path, CASE WHEN contains(url, '.com/') "
                 "THEN 'text/html; charset=UTF-8' WHEN contains(url, '.org/') THEN 'Application/JSON' END "
                 "AS content_type, html AS content FROM pages UNION ALL SELECT 'doc', doc_id, source, NULL, text "
                 "FROM documents)")
_ISJSON = "coalesce(CASE WHEN json_valid(content) THEN json_type(content) END IN ('OBJECT', 'ARRAY'), false)"
_S = f"trim(content, {_WS})"
_LOW = f"lower(trim(content, {_WS}))"


@register("detect_format_header", O.with_(_CONTENTS_SQL) +
          "SELECT kind, id, CASE WHEN instr(lower(coalesce(content_type, '')), 'application/json') > 0 THEN 'json' "
          "WHEN instr(lower(coalesce(content_type, '')), 'text/csv') > 0 THEN 'csv' "
          "WHEN instr(lower(coalesce(content_type, '')), 'text/xml') > 0 OR "
          "instr(lower(coalesce(content_type, '')), 'application/xml') > 0 THEN 'xml' "
          "WHEN instr(lower(coalesce(content_type, '')), 'text/html') > 0 THEN 'html' "
          "WHEN instr(lower(coalesce(content_type, '')), 'text/tab-separated-values') > 0 THEN 'tsv' "
          f"WHEN content IS NULL THEN 'bin' WHEN {_ISJSON} THEN 'json' "
          f"WHEN starts_with({_S}, '<') AND ends_with({_S}, '>') THEN 'xml' "
          "WHEN instr(content, ',') > 0 AND instr(content, chr(10)) > 0 THEN 'csv' ELSE 'txt' END AS format FROM x")
def q_detect_format_header(spark, sf_dir):
    x = _contents(spark, sf_dir)
    return x.select("kind", "id", FM.detect_by_header(F.col("content_type"), F.col("content")).alias("format"))


_EXT_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FM.EXTENSIONS.items())


@register("detect_format_ext", O.with_(_CONTENTS_SQL) +
          "SELECT kind, id, coalesce(CASE CASE WHEN instr(path, '.') > 0 THEN lower(split_part(path, '.', -1)) END "
          f"{_EXT_CASE} END, CASE WHEN content IS NULL THEN 'bin' WHEN {_ISJSON} THEN 'json' "
          f"WHEN starts_with({_LOW}, '<?xml') OR (starts_with({_LOW}, '<') AND ends_with({_LOW}, '>')) THEN 'xml' "
          f"WHEN starts_with({_LOW}, '<!doctype html') OR instr({_LOW}, '<html') > 0 THEN 'html' "
          "WHEN instr(content, chr(9)) > 0 AND instr(content, chr(10)) > 0 THEN 'tsv' "
          "WHEN instr(content, ',') > 0 AND instr(content, chr(10)) > 0 THEN 'csv' ELSE 'txt' END) AS format FROM x")
def q_detect_format_ext(spark, sf_dir):
    x = _contents(spark, sf_dir)
    return x.select("kind", "id", FM.detect_by_extension(F.col("path"), F.col("content")).alias("format"))


def _nested_docs(events: DataFrame) -> DataFrame:
    """One nested JSON document per event (built with to_json)."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    doc = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("meta"),
        F.array(F.struct(F.date_format("ts", iso).alias("ts"), F.col("value").alias("value")),
                F.struct(F.date_format(F.date_trunc("hour", "ts"), iso).alias("ts"),
                         (F.col("value") * 2).alias("value"))).alias("readings"),
        F.from_json("props", "k BIGINT").alias("props"),
        F.array().cast("array<string>").alias("tags"))
    return events.select("event_id", F.to_json(doc).alias("doc"))


_ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
_FLAT_SQL = ("SELECT event_id, 'id' AS key, CAST(event_id AS VARCHAR) AS value FROM events UNION ALL "
             "SELECT event_id, 'meta_type', event_type FROM events UNION ALL "
             "SELECT event_id, 'meta_user', CAST(user_id AS VARCHAR) FROM events UNION ALL "
             f"SELECT event_id, 'readings_0_ts', strftime(ts, {_ISO}) FROM events UNION ALL "
             "SELECT event_id, 'readings_0_value', CAST(value AS VARCHAR) FROM events UNION ALL "
             f"SELECT event_id, 'readings_1_ts', strftime(date_trunc('hour', ts), {_ISO}) FROM events UNION ALL "
             "SELECT event_id, 'readings_1_value', CAST(value * 2 AS VARCHAR) FROM events UNION ALL "
             "SELECT event_id, 'props_k', CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) FROM events")


@register("flatten_long", _FLAT_SQL)
def q_flatten_long(spark, sf_dir):
    return SS.flatten_json(_nested_docs(load_table(spark, sf_dir, "events")), ["event_id"], "doc")


def _payloads(events: DataFrame) -> DataFrame:
    lst = F.to_json(F.array(F.struct("value", "user_id"),
                            F.struct((F.col("value") * 2).alias("value"), "user_id")))
    p = (F.when(F.col("event_type") == "purchase", lst)
         .when(F.col("event_type") == "error", F.col("value").cast("string"))
         .otherwise(F.col("props")))
    return events.select("event_id", p.alias("payload"))


@register("payload_rows",
          "SELECT event_id, 0 AS record, 'value' AS key, CAST(value AS VARCHAR) AS value FROM events "
          "WHERE event_type IN ('purchase', 'error') UNION ALL "
          "SELECT event_id, 0, 'user_id', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' UNION ALL "
          "SELECT event_id, 1, 'value', CAST(value * 2 AS VARCHAR) FROM events WHERE event_type = 'purchase' UNION ALL "
          "SELECT event_id, 1, 'user_id', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' UNION ALL "
          "SELECT event_id, 0, 'k', CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) FROM events "
          "WHERE event_type NOT IN ('purchase', 'error')")
def q_payload_rows(spark, sf_dir):
    return SS.payload_rows(_payloads(load_table(spark, sf_dir, "events")), ["event_id"], "payload")


@register("payload_record_counts",
          "SELECT source, CAST(sum(CASE WHEN text IS NULL OR text = '' THEN 0 "
          "WHEN coalesce(CASE WHEN json_valid(text) THEN json_type(text) END = 'ARRAY', false) "
          "THEN json_array_length(CASE WHEN json_valid(text) THEN text END) "
          "WHEN coalesce(CASE WHEN json_valid(text) THEN json_type(text) END = 'OBJECT', false) THEN 1 "
          "ELSE length(text) - length(replace(text, chr(10), '')) + 1 END) AS BIGINT) AS record_count, "
          "count(*) AS payloads FROM documents GROUP BY source")
def q_payload_record_counts(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", ["source", "text"])
    return docs.groupBy("source").agg(F.sum(SS.record_count(F.col("text"))).alias("record_count"),
                                      F.count(F.lit(1)).alias("payloads"))


@register("valid_urls",
          "SELECT page_id, url, coalesce(lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) "
          "IN ('http', 'https') AND regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1) <> '', false) "
          "AS is_valid_url FROM pages")
def q_valid_urls(spark, sf_dir):
    pages = load_table(spark, sf_dir, "pages", ["page_id", "url"])
    return pages.withColumn("is_valid_url", SS.valid_url(F.col("url")))


@register("redacted_headers",
          "SELECT event_id, 'application/json' AS content_type, '[REDACTED]' AS authorization, "
          "'[REDACTED]' AS x_api_key, event_type AS user_agent, '[REDACTED]' AS set_cookie FROM events")
def q_redacted_headers(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    headers = F.create_map(
        F.lit("Content-Type"), F.lit("application/json"),
        F.lit("Authorization"), F.concat(F.lit("Bearer "), F.col("user_id").cast("string")),
        F.lit("X-API-KEY"), F.col("props"),
        F.lit("User-Agent"), F.col("event_type"),
        F.lit("Set-Cookie"), F.concat(F.lit("sid="), F.col("event_id").cast("string")))
    red = ev.select("event_id", SS.redact_headers(headers).alias("h"))
    return red.select("event_id", *[F.element_at("h", k).alias(k.lower().replace("-", "_"))
                                    for k in ("Content-Type", "Authorization", "X-API-KEY", "User-Agent",
                                              "Set-Cookie")])


# ---------------------------------------------------------------- ingest audit (AG16, JN3, PF6)

_PRIORITY_TO_SOURCE = [("1-URGENT", "7 day forecast all zones"), ("2-HIGH", "Hourly DA LMP Final"),
                       ("3-MEDIUM", "iso_ne_fuel_mix"), ("4-NOT SPECIFIED", "Morning Report")]


def run_log_from_orders(orders: DataFrame) -> DataFrame:
    """Run-log adapter: one row per order = one source pull; a daily run per order date;
    pending orders failed collection, open orders failed upload."""
    name = F.col("o_orderpriority")
    for prio, src in _PRIORITY_TO_SOURCE:
        name = F.when(F.col("o_orderpriority") == prio, src).otherwise(name)
    st = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_id"),
        name.alias("api_name"),
        F.when(st == "P", "failed").otherwise("success").alias("collection_status"),
        F.when(st == "F", "success").when(st == "O", "failed").alias("upload_status"),
        F.col("o_custkey").alias("record_count"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(st == "O", "upload failed").when(st == "P", "collection failed").alias("error"))


_SRC_CASE = " ".join(f"WHEN '{p}' THEN '{s}'" for p, s in _PRIORITY_TO_SOURCE)
_RUNLOG = ("l AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS run_id, "
           f"CASE o_orderpriority {_SRC_CASE} ELSE o_orderpriority END AS api_name, "
           "CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS collection_status, "
           "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' END AS upload_status, "
           "o_custkey AS record_count, o_orderdate AS timestamp FROM orders)")
def _cnt(cond: str) -> str:
    """DuckDB count_if yields NULL when every predicate is NULL; count(CASE) yields 0."""
    return f"count(CASE WHEN {cond} THEN 1 END)"


_OK = _cnt("collection_status = 'success'")
_NOT_OK = _cnt("collection_status <> 'success'")
_UP_FAILED = _cnt("upload_status = 'failed'")
_UP = _cnt("upload_status = 'success'")
_AUDIT = (f"SELECT run_id, count(*) AS total_apis, {_OK} AS successful_collections, "
          f"{_NOT_OK} AS failed_collections, "
          f"{_UP} AS successful_uploads, {_UP_FAILED} AS failed_uploads, "
          "CAST(epoch(max(timestamp)) - epoch(min(timestamp)) AS BIGINT) AS duration_seconds, "
          f"{O.rnd(f'{_OK} / greatest(count(*), 1)', 4)} AS collection_success_rate, "
          f"{O.rnd(f'CASE WHEN {_OK} > 0 THEN {_UP} / {_OK} ELSE 0.0 END', 4)} AS upload_success_rate, "
          f"{_UP} AS successful_end_to_end FROM l ")
_SELECTED = ["Hourly DA LMP Final", "Morning Report"]


@register("ingest_audit", O.with_(_RUNLOG) + _AUDIT + "GROUP BY run_id")
def q_ingest_audit(spark, sf_dir):
    return ingest_audit(run_log_from_orders(load_table(spark, sf_dir, "orders")))


@register("selective_audit", O.with_(_RUNLOG) + _AUDIT +
          "WHERE api_name IN ('Hourly DA LMP Final', 'Morning Report') GROUP BY run_id")
def q_selective_audit(spark, sf_dir):
    return ingest_audit(select_sources(run_log_from_orders(load_table(spark, sf_dir, "orders")), _SELECTED))


_CAT_VALUES = ", ".join(f"('{n}', '{f}', '{p}')" for n, f, p in SOURCE_CATALOGUE)


@register("source_resolution", O.with_(_RUNLOG) +
          "SELECT l.o_orderkey, l.api_name, coalesce(c.output_folder, replace(lower(l.api_name), ' ', '_')) "
          "AS folder_path, coalesce(c.csv_prefix, 'data') AS file_prefix FROM l "
          f"LEFT JOIN (VALUES {_CAT_VALUES}) c(api_name, output_folder, csv_prefix) USING (api_name)")
def q_source_resolution(spark, sf_dir):
    log = run_log_from_orders(load_table(spark, sf_dir, "orders"))
    return resolve_sources(log).select("o_orderkey", "api_name", "folder_path", "file_prefix")


# ---------------------------------------------------------------- sinks: round trips, upsert, manifest


def _roundtrip(fmt):
    def run(spark, sf_dir):
        orders = load_table(spark, sf_dir, "orders")
        path = scratch_path(spark, f"roundtrip-{fmt}")
        W.WRITERS[fmt](orders, path)
        return read_back(spark, path, fmt, orders.schema).select(*orders.columns)
    return run


for _fmt in ("csv", "tsv", "json", "parquet", "xml"):
    register(f"roundtrip_{_fmt}", "SELECT * FROM orders")(_roundtrip(_fmt))

_UPD = "('.Z.PURCHASE', '.Z.VIEW')"


@register("upsert", O.with_(O.R, O.D) +
          "SELECT timestamp, location_id, lmp_total + 1000 AS lmp_total, event_id, "
          f"strftime(timestamp, '%Y-%m-%d') AS date FROM d WHERE location_id IN {_UPD} UNION ALL "
          "SELECT timestamp, location_id, lmp_total, event_id, strftime(timestamp, '%Y-%m-%d') AS date "
          f"FROM d WHERE location_id NOT IN {_UPD}")
def q_upsert(spark, sf_dir):
    base = (dedup_first(load_readings(spark, sf_dir), ["timestamp", "location_id"], TIE_ORDER)
            .select("timestamp", "location_id", "lmp_total", "event_id",
                    F.date_format("timestamp", "yyyy-MM-dd").alias("date")))
    path = scratch_path(spark, "upsert")
    W.upsert(base, path)
    updates = (base.filter(F.col("location_id").isin(".Z.PURCHASE", ".Z.VIEW"))
               .withColumn("lmp_total", F.col("lmp_total") + 1000))
    return W.upsert(updates, path).select("timestamp", "location_id", "lmp_total", "event_id", "date")


_ORDER_COLS = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"


@register("manifest",
          f"SELECT 'csv' AS data_format, count(*) AS record_count, 6 AS columns, '{_ORDER_COLS}' AS column_names "
          "FROM orders")
def q_manifest(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    m = W.write_with_manifest(orders, scratch_path(spark, "manifest-csv"), "csv")
    return m.select("data_format", "record_count", "columns", "column_names")


# ---------------------------------------------------------------- streaming (STR1-STR3)


def _events_stream(spark, sf_dir):
    schema = load_table(spark, sf_dir, "events").schema
    return read_landing_stream(spark, sf_dir, schema, "parquet", glob="events.parquet")


def _stream_to_table(spark, stream, name):
    root = scratch_path(spark, name)
    run_available_now(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@register("stream_hourly", O.with_(O.R, HOURLY_RAW) +
          "SELECT * FROM h WHERE hour + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM r) - INTERVAL 1 HOUR")
def q_stream_hourly(spark, sf_dir):
    readings = readings_from_events(_events_stream(spark, sf_dir))
    return _stream_to_table(spark, hourly_stream(readings), "stream-hourly")


@register("stream_dedup", O.with_(O.R) + "SELECT DISTINCT timestamp, location_id FROM r")
def q_stream_dedup(spark, sf_dir):
    readings = readings_from_events(_events_stream(spark, sf_dir))
    out = _stream_to_table(spark, dedup_stream(readings), "stream-dedup")
    return out.select("timestamp", "location_id")


def _nested_struct(events: DataFrame) -> DataFrame:
    """The same nested document as ``_nested_docs``, kept as a typed struct."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    doc = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("meta"),
        F.array(F.struct(F.date_format("ts", iso).alias("ts"), F.col("value").alias("value")),
                F.struct(F.date_format(F.date_trunc("hour", "ts"), iso).alias("ts"),
                         (F.col("value") * 2).alias("value"))).alias("readings"),
        F.from_json("props", "k BIGINT").alias("props"))
    return events.select("event_id", doc.alias("doc"))


@register("flatten_struct_wide",
          "SELECT event_id, event_id AS id, event_type AS meta_type, user_id AS meta_user, "
          f"strftime(ts, {_ISO}) AS readings_0_ts, value AS readings_0_value, "
          f"strftime(date_trunc('hour', ts), {_ISO}) AS readings_1_ts, value * 2 AS readings_1_value, "
          "CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def q_flatten_struct_wide(spark, sf_dir):
    return SS.flatten_struct(_nested_struct(load_table(spark, sf_dir, "events")), ["event_id"], "doc")


_ZONE_CASE = " ".join(f"WHEN '{et}' THEN '{z}'" for et, z in EVENT_TYPE_ZONE.items())


@register("zone_enriched_codes",
          f"WITH r AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS timestamp, CASE event_type {_ZONE_CASE} END "
          "AS location_id, event_id, value AS lmp_total FROM events) "
          "SELECT r.timestamp, r.location_id, r.event_id, r.lmp_total, z.zone_id, z.zone_name FROM r "
          f"LEFT JOIN (VALUES {_ZONE_VALUES}) z(zone_id, zone_name, location_code) ON r.location_id = z.location_code")
def q_zone_enriched_codes(spark, sf_dir):
    r = (zone_coded_readings_from_events(load_table(spark, sf_dir, "events"))
         .select("timestamp", "location_id", "event_id", "lmp_total"))
    return enrich_with_zones(r)


@register("selective_summary", O.with_(_RUNLOG) +
          f"SELECT run_id, {_UP} AS successful_count, 2 AS total_count, {O.rnd(f'{_UP} / 2', 4)} AS success_rate "
          "FROM l WHERE api_name IN ('Hourly DA LMP Final', 'Morning Report') GROUP BY run_id")
def q_selective_summary(spark, sf_dir):
    return selective_summary(run_log_from_orders(load_table(spark, sf_dir, "orders")), _SELECTED)
