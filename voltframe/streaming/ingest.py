"""Structured Streaming form of the hourly re-pull (STR1-STR3).

STR1: newly landed files are read incrementally with a fixed schema, each exactly
once (the checkpoint records which files were consumed); ``availableNow`` processes
the backlog and stops, which is the hourly-trigger job.  STR2: dedup on
(timestamp, location_id) with state bounded by the watermark, the first row seen or the first by extraction time.  STR3: hourly
statistics per zone on a tumbling hour, emitted in append mode once the watermark
passes the hour; rows later than the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.operators.hourly import _stat_aggs
from voltframe.schemas import DEDUP_KEYS, PRICE_COLUMNS

DEFAULT_WATERMARK = "1 hour"


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                        glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """STR1: incremental file source (no schema inference on a stream)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt in ("csv", "tsv"):
        r = r.option("header", True)
    return r.load(path)


def _as_event_time(readings: DataFrame) -> tuple[DataFrame, bool]:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is cast (same wall clock in
    the UTC session) and cast back on output."""
    ntz = isinstance(readings.schema["timestamp"].dataType, T.TimestampNTZType)
    return (readings.withColumn("timestamp", F.col("timestamp").cast("timestamp")) if ntz else readings), ntz


def dedup_stream(readings: DataFrame, delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """STR2: drop repeated (timestamp, location_id) within the watermark."""
    ev, ntz = _as_event_time(readings)
    out = ev.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(DEDUP_KEYS)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")) if ntz else out


def first_readings_stream(readings: DataFrame, delay: str = DEFAULT_WATERMARK, order: list[str] | None = None) -> DataFrame:
    """STR2 with the batch rule of the cleaner: of the readings of one (timestamp, location_id) that
    are not late, whatever batches they come in, the first by ``order`` (NULLs last) is kept.  State is
    one row a key until the watermark passes its timestamp, and then the row is final and is emitted."""
    from voltframe.operators.clean import DEFAULT_ORDER

    ev, ntz = _as_event_time(readings)
    rest = [c for c in ev.columns if c not in DEDUP_KEYS]
    by = [c for c in (order or DEFAULT_ORDER) if c in rest]
    place = F.struct(*[x for c in by for x in (F.col(c).isNull(), F.col(c))])
    out = ev.withWatermark("timestamp", delay).groupBy(*DEDUP_KEYS).agg(F.min_by(F.struct(*rest), place).alias("first"))
    time = F.col("timestamp").cast("timestamp_ntz") if ntz else F.col("timestamp")
    return out.select(time.alias("timestamp"), "location_id", "first.*").select(*readings.columns)


def hourly_stream(readings: DataFrame, delay: str = DEFAULT_WATERMARK,
                  cols: list[str] | None = None) -> DataFrame:
    """STR3: AG1 statistics per (zone, tumbling hour)."""
    cols = cols or PRICE_COLUMNS
    ev, ntz = _as_event_time(readings)
    agg = (ev.withWatermark("timestamp", delay)
           .groupBy("location_id", F.window("timestamp", "1 hour").alias("w"))
           .agg(*_stat_aggs(cols)))
    hour = F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")
    return agg.withColumn("hour", hour).drop("w")


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      mode: str = "append") -> None:
    """Process everything landed so far, exactly once, then stop."""
    q = (stream.writeStream.format(fmt).outputMode(mode)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def enrich_stream_to_table(stream: DataFrame, table_path: str, checkpoint: str, readings_path: str | None = None,
                           **enrich_options) -> None:
    """PL1 on the hourly re-pull.  Every micro-batch is validated and cleaned, and upserted by
    (timestamp, location_id) into a date-partitioned table of readings (``readings_path``, beside
    the enriched one by default); the dates that it touches are then enriched anew from that
    table, so an hour or day that arrives in several batches gets the statistics of all its
    readings.  Both upserts are keyed: a batch replayed after a failure writes the same rows."""
    from voltframe.operators.clean import clean_readings
    from voltframe.operators.validate import batch_verdict, gate, missing_columns
    from voltframe.plans.enrich import enrich_readings
    from voltframe.sinks.writers import upsert

    readings_path = readings_path or f"{table_path.rstrip('/')}_readings"

    def each(batch: DataFrame, _batch_id: int) -> None:
        if batch.isEmpty() or missing_columns(batch):
            return
        good = clean_readings(gate(batch, batch_verdict(batch))).withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
        dates = [r[0] for r in good.select("date").distinct().collect()]     # the folders that the upsert replaces
        if not dates:
            return
        stored = upsert(good, readings_path)
        known = F.col("date").isin([d for d in dates if d is not None])
        days = stored.where(known | F.col("date").isNull() if None in dates else known).drop("date")
        upsert(enrich_readings(days, validate=False, **enrich_options).readings, table_path)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
