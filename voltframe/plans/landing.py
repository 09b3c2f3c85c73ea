"""PL4: landed payloads -> format detection -> foldered sink -> records -> manifest -> run log
and audit (SRC4, SF2, SF5, SF8, AG17, SNK8, SNK9, SNK12, AG16, STR1).

The reference handles one API response at a time on one machine.  Here a landing
folder (one sub-folder per source, one file per pull) is one table: every file is a
row, and detection and record counting are column expressions.  The payloads, bytes as they
are, go to the folder that the source catalogue names, and everything after (records,
manifest, run log) is read from what was written there.

A run is one partition of each of the four tables, named by its run id, and writing it replaces that
partition: a run that is tried again leaves what one try leaves.  The last thing written is the
run's row in ``commits``; readers see committed runs only, so a run that failed half way shows
nothing.  ``land_payloads`` lands a folder as it is; ``land_new`` lands what has come since, as
a stream whose micro-batches are runs.  A file is known by path, size and time of change: one that a
committed run holds already (the stream lost its checkpoint, or a second stream reads the folder) isn't
landed again, and the log says so.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.formats import declared_or_detected
from voltframe.functions.semistructured import payload_rejects, payload_rows, record_count
from voltframe.operators.audit import ingest_audit, resolve_sources
from voltframe.sinks.writers import NAME_TS, path_exists
from voltframe.sources.files import described_payloads, payload_text, read_payloads

TABLES = ("raw", "records", "run_log", "manifest")
# 8 row groups of 16 MB, together what one file of the usual size holds
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "8", "parquet.block.size": str(16 << 20)}
BINARY_FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                            T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


@dataclass
class LandingRun:
    run_log: DataFrame
    audit: DataFrame
    manifest: DataFrame
    rejects: DataFrame
    records_path: str
    raw_path: str


def _api_name():
    return F.regexp_extract("path", r"/([^/]+)/[^/]*$", 1).alias("api_name")


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Write the partitions that ``df`` has rows of, in the place of what they held."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


@contextlib.contextmanager
def _open_files(spark: SparkSession):
    """For rows that are many times their input: a task that writes partitions has up to ``OPEN_FILES`` files open
    at once instead of sorting its rows by partition first.  Rows of further partitions are sorted."""
    before = {k: spark.conf.get(k, None) for k in OPEN_FILES}
    try:
        for k, v in OPEN_FILES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of runs; a run id is text, whatever the folder names look like."""
    if schema is None:
        schema = spark.read.parquet(path).schema
        for f in schema.fields:
            if f.name in ("run_id", "source"):
                f.dataType = T.StringType()
    return spark.read.schema(schema).parquet(path)


def _of_run(spark: SparkSession, path: str, run: str, schema: T.StructType | None = None) -> DataFrame:
    return _read(spark, path, schema).where(F.col("run_id") == run)


def _clear(spark: SparkSession, path: str, run: str) -> None:
    """Remove what an earlier try of the run left, as a second try may have other sources."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run_id={run}")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def committed(spark: SparkSession, out_root: str, table: str) -> DataFrame | None:
    """A table of the landing (``TABLES``), committed runs only; None before the first."""
    if not path_exists(spark, f"{out_root}/commits"):
        return None
    runs = _read(spark, f"{out_root}/commits").select("run_id").distinct()
    return _read(spark, f"{out_root}/{table}").join(runs, "run_id", "left_semi")


def land(seen: DataFrame, listed: DataFrame, out_root: str, run: str, run_ts: str, catalogue: DataFrame | None = None,
         declared: str | None = None) -> None:
    """Land the payloads ``seen`` (as ``read_payloads`` gives them) as one run and commit it.
    ``listed`` (path, size, modified, known) are the files that the run is about; those that are
    ``known`` have been landed before."""
    spark = listed.sparkSession
    raw_path, records_path, log_path, manifest_path = (f"{out_root}/{x}" for x in TABLES)
    for path in (raw_path, records_path, log_path, manifest_path, f"{out_root}/commits"):
        _clear(spark, path, run)
    seen = seen.select("*", _api_name())
    if declared is not None:
        seen = seen.withColumn("format", declared_or_detected(F.lit(declared), F.col("format")))
    seen = resolve_sources(seen, catalogue).withColumns({
        "record_count": record_count(F.col("content")), "source": F.col("folder_path"), "run_id": F.lit(run)})
    raw = seen.select("api_name", "path", "format", "size", "modified", "record_count", "folder_path", "file_prefix",
                      F.col("raw").alias("content"), "source", "run_id")
    _replace(raw, raw_path, "run_id", "source")
    stored = _of_run(spark, raw_path, run, raw.schema)

    texts = stored.where("format = 'json'").select("api_name", "path", "folder_path", payload_text(F.col("content")).alias("content"))
    records = payload_rows(texts, ["api_name", "path", "folder_path"], "content")
    with _open_files(spark):
        _replace(records.withColumnRenamed("folder_path", "source").withColumn("run_id", F.lit(run)), records_path, "run_id", "source")

    # the files of the run against what was written
    names = resolve_sources(listed.select("*", _api_name()), catalogue)
    facts = stored.select("path", F.col("format").alias("data_format"), "record_count", F.lit(True).alias("there"))
    written = F.coalesce(F.col("there"), F.lit(False))
    log = names.join(facts, "path", "left").select(
        "api_name", F.when(written | F.col("known"), "success").otherwise("failed").alias("collection_status"),
        F.when(written, "success").when(F.col("known"), "skipped").alias("upload_status"),
        F.col("path").alias("s3_key"), "data_format", "record_count", F.col("size").alias("file_size_bytes"),
        F.when(~written & ~F.col("known"), "not written").alias("error"), F.col("modified").alias("timestamp"),
        "folder_path", "file_prefix", F.lit(run_ts).alias("run_ts"), F.lit(run).alias("run_id"))
    _replace(log, log_path, "run_id")

    uploaded = _of_run(spark, log_path, run, log.schema).where("upload_status = 'success'")
    manifest = uploaded.groupBy("folder_path").agg(
        F.count("*").alias("files"), F.sum("record_count").alias("record_count"), F.sum("file_size_bytes").alias("file_size_bytes"),
        F.array_sort(F.collect_set("data_format")).alias("formats")).withColumns({
            "path": F.concat(F.lit(f"{raw_path}/run_id={run}/source="), "folder_path"), "run_ts": F.lit(run_ts), "run_id": F.lit(run)})
    _replace(manifest, manifest_path, "run_id")
    _replace(spark.createDataFrame([(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), run)], "committed_at timestamp_ntz, run_id string"),
             f"{out_root}/commits", "run_id")


def land_payloads(spark: SparkSession, landing: str, out_root: str, run_ts: str | None = None, catalogue: DataFrame | None = None,
                  declared: str | None = None, run_id: str | None = None) -> LandingRun:
    """Land a folder as one run, whatever was landed before.  ``declared`` (SF8) is a format that
    the caller declares for all files; it wins over detection if it is a known one.  A payload that is not
    UTF-8 is ``bin`` and lands like any other; JSON that can't be parsed lands too and is
    listed in ``rejects``.  A file is uploaded if the written folder holds it, which is
    what the log reports.  The same ``run_id`` again replaces the run."""
    run_ts = run_ts or dt.datetime.now().strftime(NAME_TS)
    run = run_id or f"{run_ts}-{uuid.uuid4().hex[:12]}"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.lit(False).alias("known"))
    land(read_payloads(spark, landing), listed, out_root, run, run_ts, catalogue, declared)
    log = _of_run(spark, f"{out_root}/run_log", run)
    stored = _of_run(spark, f"{out_root}/raw", run)
    texts = stored.where("format = 'json'").select("api_name", "path", payload_text(F.col("content")).alias("content"))
    return LandingRun(log, ingest_audit(log), _of_run(spark, f"{out_root}/manifest", run), payload_rejects(texts, ["api_name", "path"], "content"),
                      f"{out_root}/records", f"{out_root}/raw")


def land_new(spark: SparkSession, landing: str, out_root: str, checkpoint: str, catalogue: DataFrame | None = None,
             declared: str | None = None, max_files: int = 10_000) -> None:
    """STR1: land the files that have come since the last call, each once.

    The checkpoint says which files the stream has read; a micro-batch (at most ``max_files``) is a
    run named by checkpoint and batch, so a batch that is replayed after a failure replaces what it left.
    Files that committed runs of another name hold are skipped.  ``landing`` holds a folder
    for each source."""
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    files = (spark.readStream.schema(BINARY_FILE).format("binaryFile").option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files).load(landing))

    def each(batch: DataFrame, number: int) -> None:
        run = f"{name}-{number:09d}"
        same = ["path", "size", "modified"]
        listed = batch.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
        before = committed(spark, out_root, "raw")
        if before is None:
            listed = listed.withColumn("known", F.lit(False))
        else:
            before = before.where(F.col("run_id") != run).select(*same).distinct().withColumn("known", F.lit(True))
            listed = listed.join(before, same, "left").withColumn("known", F.coalesce("known", F.lit(False)))
        if listed.isEmpty():
            return
        new = listed.where("not known").select("path")
        land(described_payloads(batch).join(new, "path", "left_semi"), listed, out_root, run, dt.datetime.now().strftime(NAME_TS), catalogue, declared)

    q = (files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
