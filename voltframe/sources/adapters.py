"""Adapters from the driver tables to the reading and kWh models.

Readings from ``events`` (the oracle uses the same text):
  timestamp = ts floored to 15 minutes, location_id = '.Z.' || upper(event_type),
  lmp_total = value, energy = value * 0.8, congestion = value * 0.15 - 2,
  loss = value * 0.05, load = user_id, extraction_time = ts, tie order event_id.
kWh series from ``events``: DateTime = ts, kWh = cast(value as decimal(15,1)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.timefields import floor_to_seconds
from voltframe.sources.tables import load_table

READING_INTERVAL_SECONDS = 15 * 60


def readings_from_events(events: DataFrame) -> DataFrame:
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        floor_to_seconds(ev, "ts", READING_INTERVAL_SECONDS).alias("timestamp"),
        F.concat(F.lit(".Z."), F.upper("event_type")).alias("location_id"),
        F.col("value").alias("lmp_total"),
        (F.col("value") * 0.8).alias("energy_component"),
        (F.col("value") * 0.15 - 2).alias("congestion_component"),
        (F.col("value") * 0.05).alias("loss_component"),
        F.col("ts").alias("extraction_time"),
        F.col("user_id").alias("load"),
        F.col("event_id"),
    )


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"))


def dirty_readings_from_events(events: DataFrame) -> DataFrame:
    """Readings with the price missing on 'error' events (the driver data has no NULLs)."""
    r = readings_from_events(events.withColumn(
        "value", F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value"))))
    return r


def text_readings_from_events(events: DataFrame) -> DataFrame:
    """Landed-as-text readings: padded ids, prices as text, 'n/a' on 'error' events."""
    r = readings_from_events(events)
    bad = F.col("location_id") == ".Z.ERROR"
    as_text = {c: F.when(bad, F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")))
               for c in ("lmp_total", "energy_component", "congestion_component", "loss_component")}
    return r.withColumns(as_text).withColumn("location_id", F.concat(F.lit(" "), F.col("location_id"), F.lit(" ")))


# Test adapter mapping event types onto load-zone codes (one type left unmatched), so
# zone joins see both matches and misses.
EVENT_TYPE_ZONE = {"view": ".Z.MAINE", "click": ".Z.NEWHAMPSHIRE", "purchase": ".Z.SEMASS",
                   "signup": ".Z.WCMASS", "error": ".Z.UNKNOWN"}


def zone_coded_readings_from_events(events: DataFrame) -> DataFrame:
    r = readings_from_events(events)
    code = F.col("location_id")
    for et, zone in EVENT_TYPE_ZONE.items():
        code = F.when(F.col("location_id") == f".Z.{et.upper()}", zone).otherwise(code)
    return r.withColumn("location_id", code)


def kwh_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("ts").alias("DateTime"),
                         F.col("value").cast("decimal(15,1)").alias("kWh"))


def load_kwh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kwh_from_events(load_table(spark, sf_dir, "events", ["ts", "value"]))


# The same adapters as DuckDB SQL (used by oracle queries).
READINGS_SQL = """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS timestamp,
       '.Z.' || upper(event_type) AS location_id,
       value AS lmp_total, value * 0.8 AS energy_component,
       value * 0.15 - 2 AS congestion_component, value * 0.05 AS loss_component,
       ts AS extraction_time, user_id AS load, event_id
FROM events"""

KWH_SQL = "SELECT ts AS DateTime, CAST(value AS DECIMAL(15,1)) AS kWh FROM events"

DIRTY_READINGS_SQL = READINGS_SQL.replace(
    "value AS lmp_total", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS lmp_total")


def _text(c: str) -> str:
    return f"CASE WHEN event_type = 'error' THEN 'n/a' ELSE ' ' || CAST({c} AS VARCHAR) || ' ' END"


TEXT_READINGS_SQL = f"""
SELECT time_bucket(INTERVAL '15 minutes', ts) AS timestamp,
       ' .Z.' || upper(event_type) || ' ' AS location_id,
       {_text('value')} AS lmp_total, {_text('value * 0.8')} AS energy_component,
       {_text('value * 0.15 - 2')} AS congestion_component, {_text('value * 0.05')} AS loss_component,
       ts AS extraction_time, user_id AS load, event_id
FROM events"""
