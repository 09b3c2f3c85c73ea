"""Registered stream queries over several micro-batches and a restart (STR1-STR3).

``events`` land as pulls of files, most of them in the order of time, some late by one pull or by
three.  A stream reads a pull a micro-batch, stops after half of the pulls as a triggered job
does, and goes on from its checkpoint when the others have landed.  Which rows are late is a matter of
the pull alone, and the SQL says it: a batch drops what the watermark of the batch before it had
passed already.  A job's first batch comes after the closing batch of the job before, which
carries no data but moves the watermark on.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.plans import oracle_sql as O
from voltframe.plans.catalog import HOURLY_RAW, TIE_ORDER, register
from voltframe.plans.landing import committed, land_new
from voltframe.plans.rules_catalog import IDS_A_FILE, _land_files
from voltframe.session import scratch_path
from voltframe.sources.adapters import READINGS_SQL, readings_from_events
from voltframe.sources.tables import load_table
from voltframe.streaming.ingest import dedup_stream, first_readings_stream, hourly_stream, read_landing_stream, run_available_now

PULLS, FILES_A_PULL = 6, 2
# pull -> the last pull that the watermark of the batch before had seen, with a stop after the third
SEEN_BEFORE = {3: 1, 4: 3, 5: 3, 6: 4}


def _pull_of(events):
    """Pull (1 to 6) of every event: its sixth of the span of time, one later for some and three for others."""
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(second), F.max(second)).first()
    late = F.when(F.col("event_id") % 7 == 0, 3).when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    return F.least(F.expr(f"int({PULLS} * (unix_seconds(cast(ts AS timestamp)) - {first or 0}) div {(last or 0) - (first or 0) + 1})") + late, F.lit(PULLS - 1)) + 1


_PULL_SQL = (f"SELECT *, 1 + least({PULLS - 1}, {PULLS} * date_diff('second', (SELECT min(ts) FROM events), ts) // "
             "(date_diff('second', (SELECT min(ts) FROM events), (SELECT max(ts) FROM events)) + 1) "
             "+ CASE WHEN event_id % 7 = 0 THEN 3 WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS pull FROM events")
_ROWS = "r0 AS (" + READINGS_SQL.replace("event_id\nFROM events", f"event_id, pull FROM ({_PULL_SQL})") + ")"
_BOUNDS = "b AS (SELECT pull, max(timestamp) - INTERVAL 1 HOUR AS passed FROM (VALUES " + ", ".join(
    f"({p}, {s})" for p, s in SEEN_BEFORE.items()) + ") AS v(pull, seen) JOIN (SELECT timestamp, pull AS p FROM r0) ON p <= seen GROUP BY pull)"
_END = "(SELECT max(timestamp) FROM r0) - INTERVAL 1 HOUR"


def _in_time(moment: str) -> str:
    """Rows of r0 that are not late when ``moment`` is what the watermark must not have passed."""
    return f"r AS (SELECT r0.* EXCLUDE (pull) FROM r0 LEFT JOIN b USING (pull) WHERE passed IS NULL OR {moment} > passed)"


def run_in_pulls(spark, sf_dir, name, build):
    """What ``build(readings stream)`` writes when half of the pulls have landed and then the rest."""
    events = load_table(spark, sf_dir, "events")
    root, pulled = scratch_path(spark, name), events.withColumn("pull", _pull_of(events))
    stream = read_landing_stream(spark, f"{root}/in/*", events.schema, "parquet", max_files_per_trigger=FILES_A_PULL)
    out = None
    for job in (range(1, PULLS // 2 + 1), range(PULLS // 2 + 1, PULLS + 1)):
        for pull in job:
            pulled.where(F.col("pull") == pull).drop("pull").repartition(FILES_A_PULL).write.parquet(f"{root}/in/pull-{pull}")
        out = build(readings_from_events(stream))
        run_available_now(out, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{root}/out")


@register("stream_hourly_batches", O.with_(_ROWS, _BOUNDS, _in_time("date_trunc('hour', r0.timestamp) + INTERVAL 1 HOUR"), HOURLY_RAW) +
          f"SELECT * FROM h WHERE hour + INTERVAL 1 HOUR <= {_END}")
def q_stream_hourly_batches(spark, sf_dir):
    return run_in_pulls(spark, sf_dir, "stream-hourly-batches", hourly_stream)


@register("stream_dedup_batches", O.with_(_ROWS, _BOUNDS, _in_time("r0.timestamp")) + "SELECT DISTINCT timestamp, location_id FROM r")
def q_stream_dedup_batches(spark, sf_dir):
    return run_in_pulls(spark, sf_dir, "stream-dedup-batches", dedup_stream).select("timestamp", "location_id")


@register("stream_first_batches", O.with_(_ROWS, _BOUNDS, _in_time("r0.timestamp"), O.D) + f"SELECT * FROM d WHERE timestamp <= {_END}")
def q_stream_first_batches(spark, sf_dir):
    return run_in_pulls(spark, sf_dir, "stream-first-batches", lambda r: first_readings_stream(r, order=TIE_ORDER))


@register("landing_incremental",
          "WITH f AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type, CAST(ts AS DATE), "
          f"event_id // {IDS_A_FILE}) SELECT 'api=pull-' || event_type AS folder_path, count(*) AS files, "
          "CAST(sum(n) AS BIGINT) AS records, count(*) AS manifest_files, CAST(sum(n) AS BIGINT) AS manifest_records, "
          "count(*) AS uploaded, 2 * count(*) AS listed, CAST(sum(n) AS BIGINT) AS event_ids FROM f GROUP BY event_type")
def q_landing_incremental(spark, sf_dir):
    """Lands, lands again with nothing new, adds files, lands again, and then once more with a checkpoint
    that knows nothing: every file is landed once, and listed once for each checkpoint."""
    root = scratch_path(spark, "landing-incremental")
    even = F.dayofmonth("day") % 2 == 0
    for part, checkpoint in ((even, "a"), (None, "a"), (~even, "a"), (None, "b")):
        if part is not None:
            _land_files(spark, sf_dir, f"{root}/in", part)
        land_new(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint-{checkpoint}", declared="json")
    raw, records, log, manifest = (committed(spark, f"{root}/out", t) for t in ("raw", "records", "run_log", "manifest"))
    by = [raw.groupBy("folder_path").agg(F.count("*").alias("files"), F.sum("record_count").alias("records")),
          manifest.groupBy("folder_path").agg(F.sum("files").alias("manifest_files"), F.sum("record_count").alias("manifest_records")),
          log.groupBy("folder_path").agg(F.count_if(F.col("upload_status") == "success").alias("uploaded"), F.count("*").alias("listed")),
          records.where("key = 'event_id'").groupBy(F.col("source").alias("folder_path")).agg(F.count_distinct("value").alias("event_ids"))]
    out = by[0]
    for other in by[1:]:
        out = out.join(other, "folder_path")
    return out
