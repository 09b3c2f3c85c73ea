"""Sinks (SNK1-SNK15): every format the reference writes, as distributed writers.

Frames are written by all tasks in parallel (one part file per task); nothing is
gathered on the driver.  Foldered and date-path layouts are ``partitionBy`` columns.
The manifest counts records during the write pass (``Observation``) and sizes from a
metadata-only listing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.formats import folder_name
from voltframe.schemas import DEDUP_KEYS, MANIFEST
from voltframe.sources.files import HTML_ESCAPES, RECORD_SEPARATOR, list_files

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Text that reads back unchanged: quotes doubled, nothing trimmed, empty text quoted (NULL is bare).
DELIMITED = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "emptyValue": '""', "nullValue": "", "timestampFormat": ISO_TS, "timestampNTZFormat": ISO_TS}
# Default file prefix and the upload timestamp pattern in file names.
DEFAULT_FILE_PREFIX = "energy_data"
NAME_TS = "%Y%m%d_%H%M%S"


def sorted_for_sink(df: DataFrame, by: list[str]) -> DataFrame:
    """SL1 at a sink: order rows inside each output file (no global sort, no extra
    shuffle); use ``orderBy`` only where one global order is the feature."""
    return df.sortWithinPartitions(*by)


# Text that reads back unchanged: quotes doubled, nothing trimmed, empty text quoted (NULL is bare).
DELIMITED = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "emptyValue": '""', "nullValue": "", "timestampFormat": ISO_TS, "timestampNTZFormat": ISO_TS}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1: CSV with a header line, no index."""
    df.write.mode(mode).options(**DELIMITED).csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: tab-separated (also the reference's frame-as-text form)."""
    df.write.mode(mode).options(**DELIMITED).option("sep", "\t").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3: JSON records (one per line), ISO timestamps."""
    df.write.mode(mode).option("timestampFormat", ISO_TS).option("timestampNTZFormat", ISO_TS).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SNK4."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_xml(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK5: one <row> element per record under a <data> root; element names follow
    the reference's rule (' ' and '-' become '_')."""
    renamed = df.select(*[F.col(f"`{c}`").alias(c.replace(" ", "_").replace("-", "_")) for c in df.columns])
    (renamed.write.mode(mode).format("xml").option("rowTag", "row").option("rootTag", "data")
     .option("timestampFormat", ISO_TS).save(path))


def _escape(c):
    for plain, spelled in HTML_ESCAPES.items():
        c = F.replace(c, F.lit(plain), F.lit(spelled))
    return c


def html_rows(df: DataFrame) -> DataFrame:
    """SNK6 body: one escaped ``<tr><td>..</td></tr>`` line per record."""
    cells = [F.concat(F.lit("<td>"), _escape(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit("</td>"))
             for c in df.columns]
    return df.select(F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("value"))


def html_head(columns: list[str]) -> str:
    for plain, spelled in HTML_ESCAPES.items():
        columns = [c.replace(plain, spelled) for c in columns]
    return "<table><thead><tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr></thead><tbody>"


def write_html(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK6: every part file is a whole table with its header; tasks write in parallel."""
    head = html_head(df.columns)

    def whole(batches):
        import pyarrow as pa

        def lines(column):
            return pa.RecordBatch.from_arrays([column], names=["value"])
        yield lines(pa.array([head]))
        for batch in batches:
            yield lines(batch.column(0))
        yield lines(pa.array(["</tbody></table>"]))
    html_rows(df).mapInArrow(whole, "value string").write.mode(mode).text(path)


# YAML escapes of what a single-quoted scalar can't hold (line ends would fold).
YAML_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\x85": "\\N", "\u2028": "\\L", "\u2029": "\\P",
                "\x7f": "\\x7f", **{chr(i): f"\\x{i:02x}" for i in range(32) if i not in (9, 10, 13)}}


def _yaml_text(c):
    """Single-quoted, or double-quoted with escapes where control characters or line ends are."""
    escaped = c
    for plain, spelled in YAML_ESCAPES.items():
        escaped = F.replace(escaped, F.lit(plain), F.lit(spelled))
    plain = F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    special = c.rlike(r"[\x00-\x1f\x7f\x85\u2028\u2029]")
    return F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(plain)


def yaml_records(df: DataFrame) -> DataFrame:
    """SNK7 body: a block-style YAML list item per record, keys sorted.  Numbers and
    booleans are plain scalars (floats as Python prints them), dates and timestamps
    ISO, strings single-quoted, NULL as ``null``: the values keep their types."""
    from pyspark.sql import types as T

    from voltframe.functions.semistructured import py_float_text
    keys = sorted(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def val(c):
        col, t = F.col(f"`{c}`"), types[c]
        if isinstance(t, (T.FloatType, T.DoubleType)):
            d = col.cast("double")
            py = py_float_text(d)
            # YAML 1.1 floats need a '.', and infinities/NaN have their own spellings
            text = (F.when(F.isnan(d), ".nan").when(d == float("inf"), ".inf").when(d == float("-inf"), "-.inf")
                    .when((F.instr(py, ".") == 0) & (F.instr(py, "e") > 0), F.replace(py, F.lit("e"), F.lit(".0e")))
                    .otherwise(py))
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
            text = col.cast("string")
        elif isinstance(t, T.BooleanType):
            text = F.when(col, "true").otherwise("false")
        elif isinstance(t, T.DateType):
            text = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            text = _yaml_text(col.cast("string"))
        return F.when(col.isNull(), F.lit("null")).otherwise(text)
    lines = [F.concat(F.lit(("- " if i == 0 else "  ") + f"{k}: "), val(k)) for i, k in enumerate(keys)]
    return df.select(F.concat_ws("\n", *lines).alias("value"))


def write_yaml(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    yaml_records(df).write.mode(mode).text(path)


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    """SNK8: pass-through of a text payload column, one payload between two separators."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).option("lineSep", RECORD_SEPARATOR).text(path)


def write_payloads(df: DataFrame, path: str, column: str = "content", mode: str = "overwrite") -> None:
    """SNK8 for bytes: payloads of any kind as they are, one per row."""
    df.withColumn(column, F.col(column).cast("binary")).write.mode(mode).parquet(path)


WRITERS = {"csv": write_csv, "tsv": write_tsv, "txt": write_tsv, "json": write_json, "parquet": write_parquet,
           "xml": write_xml, "html": write_html, "yaml": write_yaml}


def with_provenance(df: DataFrame, api_name: str, unique_id: str | None = None) -> DataFrame:
    """SNK14: stamp api_name, ingest time and a short run id.  The ingest time is named
    ``ingest_timestamp`` so it cannot overwrite a reading's own ``timestamp``."""
    return df.withColumns({"api_name": F.lit(api_name), "ingest_timestamp": F.current_timestamp(),
                           "unique_id": F.lit(unique_id or uuid.uuid4().hex[:8])})


def foldered_path(root: str, source: str, prefix: str | None, fmt: str,
                  when: dt.datetime | None = None, unique_id: str | None = None,
                  folder: str | None = None) -> str:
    """SNK9 name rule: <folder>/<prefix>_<yyyyMMdd_HHmmss>[_id].<ext>, folder from the
    config or the lower-cased source name with '_'."""
    when = when or dt.datetime.now()
    folder = folder or source.lower().replace(" ", "_")
    name = f"{prefix or DEFAULT_FILE_PREFIX}_{when.strftime(NAME_TS)}" + (f"_{unique_id}" if unique_id else "")
    return f"{root.rstrip('/')}/{folder.strip('/')}/{name}.{fmt}"


def write_foldered(df: DataFrame, root: str, source_col: str = "api_name", fmt: str = "parquet",
                   run_ts: str | None = None, mode: str = "append") -> None:
    """SNK9 as a table layout: partition folders per source and run."""
    run_ts = run_ts or dt.datetime.now().strftime(NAME_TS)
    out = df.withColumns({"source": folder_name(F.col(source_col)), "run_ts": F.lit(run_ts)})
    out.write.mode(mode).partitionBy("source", "run_ts").format(fmt).save(root)


def write_date_path(df: DataFrame, root: str, ts_col: str = "DateTime", fmt: str = "csv",
                    mode: str = "append") -> None:
    """SNK10: year/month/day folders (with a header per CSV part)."""
    out = df.withColumns({"year": F.date_format(ts_col, "yyyy"), "month": F.date_format(ts_col, "MM"),
                          "day": F.date_format(ts_col, "dd")})
    w = out.write.mode(mode).partitionBy("year", "month", "day").format(fmt)
    if fmt == "csv":
        w = w.options(**DELIMITED)
    w.save(root)


def path_exists(spark, path: str) -> bool:
    """Whether a folder or file is there; storage errors other than its absence are raised."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


SCHEMA_FILE = "_table_schema"


def _stored_schema(spark, path: str) -> T.StructType | None:
    if not path_exists(spark, f"{path}/{SCHEMA_FILE}"):
        return None
    return T.StructType.fromJson(json.loads(_read_small(spark, f"{path}/{SCHEMA_FILE}")))


def _read_small(spark, path: str) -> str:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _keep_schema(spark, path: str, schema: T.StructType) -> None:
    """Write the table's schema beside its data, under a name that readers of folders pass over."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    where = fs.Path(f"{path}/{SCHEMA_FILE}")
    stream = where.getFileSystem(conf).create(where, True)
    try:
        stream.write(schema.json().encode())
    finally:
        stream.close()


def stored_table(spark, path: str, partition_col: str, partition_type=None) -> DataFrame:
    """The stored table with all columns that any of its files has.  They stand in a small file beside
    the data; only a table that lacks it (written by other means) has its footers merged, once.  The
    partition column keeps the given type (folder names alone would turn '007' into a number)."""
    found = _stored_schema(spark, path)
    if found is None:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        _keep_schema(spark, path, found)
    for f in found.fields:
        if f.name == partition_col and partition_type is not None:
            f.dataType = partition_type
    return spark.read.schema(found).parquet(path)


def upsert(new: DataFrame, path: str, keys: list[str] | None = None, partition_col: str = "date",
           order: list[str] | None = None) -> DataFrame:
    """SNK11: insert-or-replace rows by key into a parquet table partitioned by
    ``partition_col``.  Only partitions that the batch touches are rewritten (dynamic
    partition overwrite), the NULL partition like any other (a folder name can't tell the
    empty text from NULL, so it counts as NULL).  Inside them the batch's row wins per key.

    The batch may hold a key more than once: the row that comes first by ``order`` (the
    dedup order by default, NULLs last, then the remaining columns) is the one stored.  The
    table keeps its columns: those that the batch lacks keep the stored value of a replaced
    row and are NULL in a new one; columns that only the batch has are added.  The
    preference is an aggregate, so a hot key combines map-side.  Single writer per table."""
    from voltframe.operators.clean import DEFAULT_ORDER, dedup_first

    spark = new.sparkSession
    keys = keys or DEDUP_KEYS
    rest = [c for c in new.columns if c not in keys]
    first = [c for c in (order or DEFAULT_ORDER) if c in rest]
    new = dedup_first(new, keys, first + [c for c in rest if c not in first])
    kind = new.schema[partition_col].dataType
    if isinstance(kind, T.StringType):
        new = new.withColumn(partition_col, F.nullif(partition_col, F.lit("")))
    if not path_exists(spark, path):
        _keep_schema(spark, path, T.StructType([f for f in new.schema.fields if f.name != partition_col] + [new.schema[partition_col]]))
        new.write.mode("append").partitionBy(partition_col).parquet(path)
        return stored_table(spark, path, partition_col, kind)
    existing = stored_table(spark, path, partition_col, kind)
    # one value for each folder that the commit is about to replace, a list that the writer's
    # commit holds as well; as a literal filter it prunes the scan of the stored table
    touched = [r[0] for r in new.select(partition_col).distinct().collect()]
    here = F.col(partition_col).isin([v for v in touched if v is not None])
    if None in touched:
        here = here | F.col(partition_col).isNull()
    old = existing.filter(here)
    cols = existing.columns + [c for c in new.columns if c not in existing.columns]
    rest = [c for c in cols if c not in keys]
    both = (new.select(*keys, F.struct(*[c for c in rest if c in new.columns]).alias("_new"))
            .unionByName(old.select(*keys, F.struct(*[c for c in rest if c in old.columns]).alias("_old")), allowMissingColumns=True))
    merged = both.groupBy(*keys).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    picked = []
    for c in rest:
        mine, stored = (F.col(f"{side}.`{c}`") if c in frame.columns else None for side, frame in (("_new", new), ("_old", old)))
        if mine is None:
            picked.append(stored.alias(c))
        else:
            picked.append(F.when(F.col("_new").isNotNull(), mine).otherwise(F.lit(None) if stored is None else stored).alias(c))
    added = [new.schema[c] for c in cols if c not in existing.columns]
    if added:
        known = existing.schema.fields
        _keep_schema(spark, path, T.StructType([*(f for f in known if f.name != partition_col), *added, existing.schema[partition_col]]))
    (merged.select(*keys, *picked).select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return stored_table(spark, path, partition_col, kind)


def write_with_manifest(df: DataFrame, path: str, fmt: str, manifest_path: str | None = None,
                        metadata: dict | None = None) -> DataFrame:
    """SNK12: write, counting records in the same pass, then describe the upload (format,
    records, columns, names, bytes, time) as a one-row frame; appended to
    ``manifest_path`` when given."""
    spark = df.sparkSession
    obs = Observation("manifest")
    observed = df.observe(obs, F.count(F.lit(1)).alias("records"))
    WRITERS[fmt](observed, path)
    records = obs.get["records"]
    size = list_files(spark, path).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    row = (path, fmt, int(records), len(df.columns), ",".join(df.columns), int(size),
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    manifest = spark.createDataFrame([row], MANIFEST)
    if metadata:   # custom key/values ride along as text, as object metadata does
        manifest = manifest.withColumn("metadata", F.create_map(*[x for k, v in sorted(metadata.items())
                                                                  for x in (F.lit(str(k)), F.lit(str(v)))]))
    if manifest_path:
        manifest.write.mode("append").parquet(manifest_path)
    return manifest


def save_data(df: DataFrame, root: str, file_prefix: str = DEFAULT_FILE_PREFIX, data_format: str | None = None,
              folder_path: str | None = None, include_timestamp: bool = True, unique_id: str | None = None,
              when: dt.datetime | None = None, manifest_path: str | None = None) -> DataFrame:
    """Save a frame under the foldered, time-stamped name rule and describe the upload
    (manifest row).  Frames default to CSV, as in the reference; ``folder_path`` is
    stripped of slashes; without a timestamp the name is just ``<prefix>.<ext>``."""
    fmt = (data_format or "csv").lower()
    if fmt not in WRITERS:
        raise ValueError(f"unsupported frame format: {fmt}")
    when = when or dt.datetime.now()
    name = f"{file_prefix}_{when.strftime(NAME_TS)}" if include_timestamp else file_prefix
    if unique_id:
        name = f"{name}_{unique_id}"
    folder = (folder_path or "").strip("/")
    path = f"{root.rstrip('/')}/{folder + '/' if folder else ''}{name}.{fmt}"
    return write_with_manifest(df, path, fmt, manifest_path)


def save_to_storage(enriched: DataFrame, root: str, date: str, run_id: str | None = None, json_writer=write_json) -> dict[str, str]:
    """SNK15: table upsert + CSV + JSON + batch metadata in one call, returning the
    paths.  The frame is persisted once (memory and disk) so the four writes share one
    computation.  An empty batch writes nothing and returns no paths (PF8).

    Everything goes to a folder of the run's own, and becomes visible as one: the last write is
    the run's row in ``manifest``, which ``published`` reads.  A call that fails on the way
    publishes nothing; the same ``run_id`` again starts over.  The table is upserted from the run's own
    rows after that row is written; the upsert is keyed, so a retry repeats it without harm.  ``json_writer`` writes the JSON
    files (another line layout, say)."""
    from voltframe.operators.summaries import batch_metadata
    if enriched.isEmpty():
        return {}
    spark, run = enriched.sparkSession, run_id or uuid.uuid4().hex
    cached = enriched.persist()
    try:
        own = f"{root}/runs/{run}"
        paths = {"rows": f"{own}/rows", "csv": f"{own}/processed/lmp_data_{date}.csv", "json": f"{own}/raw/lmp_processed_{date}.json",
                 "metadata": f"{own}/processed/metadata_{date}.json"}
        write_parquet(cached, paths["rows"])
        write_csv(sorted_for_sink(cached, DEDUP_KEYS), paths["csv"])
        json_writer(cached, paths["json"])
        json_writer(batch_metadata(cached, nested=True).withColumn("date", F.lit(date)), paths["metadata"])
        row = (date, paths["rows"], paths["csv"], paths["json"], paths["metadata"], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), run)
        spark.createDataFrame([row], PUBLISHED).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{root}/manifest")
        paths["table"] = f"{root}/lmp_data"
        upsert(spark.read.parquet(paths["rows"]), paths["table"])
        return paths
    finally:
        cached.unpersist()


PUBLISHED = "date string, rows string, csv string, json string, metadata string, published_at timestamp_ntz, run_id string"


def published(spark, root: str) -> DataFrame:
    """The runs that ``save_to_storage`` has published: date, run_id, the paths of their files and
    when; for each date the newest counts (``newest``)."""
    if not path_exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], PUBLISHED + ", newest boolean")
    runs = spark.read.schema(PUBLISHED).parquet(f"{root}/manifest")
    newest = runs.groupBy("date").agg(F.max_by("run_id", F.struct("published_at", "run_id")).alias("_newest"))
    return runs.join(newest, "date").withColumn("newest", F.col("run_id") == F.col("_newest")).drop("_newest")
