"""Registered queries on data that exercises the rules: bad times, NaN, far prices, upserts of every
kind, JSON of mixed shape, every sink on real text, layouts, listing and landing.

All data comes from the given tables; the adapters here only make the cases that the tables
lack (the oracle states the same adapter in SQL).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.functions import formats as FM
from voltframe.functions import semistructured as SS
from voltframe.functions.timefields import add_time_fields
from voltframe.operators.clean import bad_times, cleaning_report, dedup_first
from voltframe.operators.validate import batch_verdict, outlier_flag, quarantine
from voltframe.plans import oracle_sql as O
from voltframe.plans.catalog import _TIME_OUT, _ZONE_CASE, RD, TIE_ORDER, register
from voltframe.plans.enrich import enrich_readings
from voltframe.plans.landing import land_payloads
from voltframe.session import scratch_path
from voltframe.sinks import writers as W
from voltframe.sources.adapters import READINGS_SQL, load_kwh, load_readings, readings_from_events, zone_coded_readings_from_events
from voltframe.sources.files import list_files, read_back, read_kwh_csv, read_readings_json
from voltframe.sources.tables import load_table
from voltframe.sources.zones import LOAD_ZONES, load_zone_filter

# ---------------------------------------------------------------- entry rules: times that are none, NaN, a missing column


def _rough(spark, sf_dir):
    """Readings as landed: times as text, no time on 'signup', prices far out on 'click'."""
    ev = load_table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "click", F.col("value") * 100 - 3000).otherwise(F.col("value"))
    r = readings_from_events(ev.withColumn("value", value))
    bad = F.col("location_id") == ".Z.SIGNUP"
    return r.withColumn("timestamp", F.when(bad, F.concat(F.lit("no time "), F.col("event_id"))).otherwise(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")))


_FAR = "CASE WHEN event_type = 'click' THEN value * 100 - 3000 ELSE value END"
_ROUGH = "r AS (" + READINGS_SQL.replace("FROM events", f"FROM (SELECT * REPLACE ({_FAR} AS value) FROM events)") + ")"
_GOOD = "g AS (SELECT * FROM r WHERE location_id <> '.Z.SIGNUP')"
_GOOD_D = O.D.replace("FROM r)", "FROM g)")
_OUT = "count(CASE WHEN NOT coalesce(lmp_total BETWEEN -1000 AND 1000, false) THEN 1 END)"
_NONE = "CAST(0 AS BIGINT)"


@register("verdict_bad_times", O.with_(_ROUGH) +
          f"SELECT count(*) AS row_count, {_NONE} AS null_timestamp, {_NONE} AS null_location_id, {_NONE} AS null_lmp_total, "
          f"{_OUT} AS outlier_count, count(CASE WHEN location_id = '.Z.SIGNUP' THEN 1 END) AS rejected_times, "
          "'' AS missing_columns, true AS is_valid, count(*) = 0 AS is_empty FROM r")
def q_verdict_bad_times(spark, sf_dir):
    return enrich_readings(_rough(spark, sf_dir), order=TIE_ORDER).verdict


@register("enriched_bad_times", O.with_(_ROUGH, _GOOD, _GOOD_D) + "SELECT timestamp, location_id, event_id, lmp_total FROM d")
def q_enriched_bad_times(spark, sf_dir):
    out = enrich_readings(_rough(spark, sf_dir), order=TIE_ORDER).readings
    return out.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "location_id", "event_id", "lmp_total")


@register("rejected_times", "SELECT event_id, 'no time ' || event_id AS timestamp FROM events WHERE event_type = 'signup'")
def q_rejected_times(spark, sf_dir):
    return bad_times(_rough(spark, sf_dir)).select("event_id", "timestamp")


@register("cleaning_report_bad_times", O.with_(_ROUGH, _GOOD, _GOOD_D) +
          "SELECT count(*) AS output_rows, (SELECT count(*) FROM r) AS input_rows, "
          "(SELECT count(*) FROM r) - (SELECT count(*) FROM g) AS rejected_times, "
          "(SELECT count(*) FROM g) - count(*) AS duplicates_removed FROM d")
def q_cleaning_report_bad_times(spark, sf_dir):
    report = cleaning_report(_rough(spark, sf_dir), TIE_ORDER)
    return report.select("output_rows", "input_rows", "rejected_times", "duplicates_removed")


@register("outlier_flags_far", O.with_(_ROUGH) +
          "SELECT event_id, lmp_total, NOT coalesce(lmp_total BETWEEN -1000 AND 1000, false) AS is_outlier FROM r")
def q_outlier_flags_far(spark, sf_dir):
    return outlier_flag(_rough(spark, sf_dir)).select("event_id", "lmp_total", "is_outlier")


def _with_nan(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return readings_from_events(ev.withColumn("value", value))


@register("verdict_nan", O.with_(RD) +
          f"SELECT count(*) AS row_count, {_NONE} AS null_timestamp, {_NONE} AS null_location_id, "
          f"count(CASE WHEN lmp_total IS NULL THEN 1 END) AS null_lmp_total, {_OUT} AS outlier_count, {_NONE} AS rejected_times, "
          "'' AS missing_columns, count(lmp_total) = count(*) AS is_valid, count(*) = 0 AS is_empty FROM r")
def q_verdict_nan(spark, sf_dir):
    return batch_verdict(_with_nan(spark, sf_dir))


@register("quarantine_nan", "SELECT event_id, event_type = 'error' AS rejected FROM events")
def q_quarantine_nan(spark, sf_dir):
    good, bad = quarantine(_with_nan(spark, sf_dir))
    return good.select("event_id", F.lit(False).alias("rejected")).unionByName(bad.select("event_id", F.lit(True).alias("rejected")))


@register("verdict_missing_column",
          f"SELECT count(*) AS row_count, 'congestion_component' AS missing_columns, false AS is_valid, {_NONE} AS readings FROM events")
def q_verdict_missing_column(spark, sf_dir):
    e = enrich_readings(load_readings(spark, sf_dir).drop("congestion_component"), order=TIE_ORDER)
    return e.verdict.select("row_count", "missing_columns", "is_valid", F.lit(e.readings.count()).alias("readings"))


@register("empty_batch", "SELECT count(*) AS row_count, true AS is_empty FROM events WHERE event_id < 0")
def q_empty_batch(spark, sf_dir):
    return batch_verdict(load_readings(spark, sf_dir).where("event_id < 0")).select("row_count", "is_empty")


# Readings spread over the months of a year: all seasons and quarters.
_YEAR = O.R.replace("time_bucket(INTERVAL '15 minutes', ts) AS timestamp",
                    "time_bucket(INTERVAL '15 minutes', ts) + INTERVAL 1 MONTH * (event_id % 12) AS timestamp")


@register("time_fields_year", O.with_(_YEAR, "c AS (SELECT * FROM r)", O.T0, O.T) + f"SELECT {_TIME_OUT} FROM t")
def q_time_fields_year(spark, sf_dir):
    r = load_readings(spark, sf_dir)
    later = F.col("timestamp") + F.make_ym_interval(F.lit(0), (F.col("event_id") % 12).cast("int"))
    return add_time_fields(r.withColumn("timestamp", later)).select(*[c.strip() for c in _TIME_OUT.split(",")])


# ---------------------------------------------------------------- upsert: NULL partition, narrower batch, repeated keys

_BASE = ("b AS (SELECT timestamp, location_id, lmp_total, event_id, CASE WHEN event_id % 3 = 0 THEN NULL "
         "ELSE strftime(timestamp, '%Y-%m-%d') END AS date FROM d)")


def _upsert_base(spark, sf_dir):
    base = dedup_first(load_readings(spark, sf_dir), ["timestamp", "location_id"], TIE_ORDER)
    date = F.when(F.col("event_id") % 3 != 0, F.date_format("timestamp", "yyyy-MM-dd"))
    return base.select("timestamp", "location_id", "lmp_total", "event_id", date.alias("date"))


@register("upsert_null_partition", O.with_(O.R, O.D, _BASE) +
          "SELECT timestamp, location_id, CASE WHEN date IS NULL AND event_id % 2 = 0 THEN -1.0 ELSE lmp_total END AS lmp_total, "
          "event_id, date FROM b")
def q_upsert_null_partition(spark, sf_dir):
    base, path = _upsert_base(spark, sf_dir), scratch_path(spark, "upsert-null")
    W.upsert(base, path)
    batch = base.where("date IS NULL AND event_id % 2 = 0").withColumn("lmp_total", F.lit(-1.0))
    return W.upsert(batch, path).select(*base.columns)


@register("upsert_narrow_batch", O.with_(O.R, O.D, _BASE) +
          "SELECT timestamp, location_id, CASE WHEN event_id % 2 = 0 THEN -1.0 ELSE lmp_total END AS lmp_total, event_id, date FROM b")
def q_upsert_narrow_batch(spark, sf_dir):
    base, path = _upsert_base(spark, sf_dir), scratch_path(spark, "upsert-narrow")
    W.upsert(base, path)
    batch = base.where("event_id % 2 = 0").select("timestamp", "location_id", F.lit(-1.0).alias("lmp_total"), "date")
    return W.upsert(batch, path).select(*base.columns)


@register("upsert_repeated_keys", O.with_(O.R, O.D) + "SELECT timestamp, location_id, lmp_total, event_id FROM d")
def q_upsert_repeated_keys(spark, sf_dir):
    """The first write holds keys more than once; so does the second, which changes nothing."""
    rows, path = load_readings(spark, sf_dir), scratch_path(spark, "upsert-repeated")
    rows = rows.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    W.upsert(rows, path, order=TIE_ORDER)
    return W.upsert(rows, path, order=TIE_ORDER).select("timestamp", "location_id", "lmp_total", "event_id")


# ---------------------------------------------------------------- JSON of mixed shape, and what is no JSON


def _mixed(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    k, kind = F.col("event_id").cast("string"), F.col("event_id") % 4
    doc = (F.when(kind == 0, F.concat(F.lit('{"a": [1, [2, '), k, F.lit(']], "a_0": "later"}')))
           .when(kind == 1, F.concat(F.lit('{"r": [{"x": 1}, {"x": {"y": '), k, F.lit('}}], "e": {}, "l": []}')))
           .when(kind == 2, F.concat(F.lit('{"k": 1, "k": '), k, F.lit("}")))
           .otherwise(F.concat(F.lit('{"broken": '), k)))
    return ev.select("event_id", doc.alias("doc"))


def _leaf(rest, key, value):
    return f"SELECT event_id, '{key}' AS key, {value} AS value FROM events WHERE event_id % 4 = {rest}"


_ID = "CAST(event_id AS VARCHAR)"


@register("flatten_mixed", " UNION ALL ".join(_leaf(*x) for x in (
    (0, "a_0", "'later'"), (0, "a_1_0", "'2'"), (0, "a_1_1", _ID), (1, "r_0_x", "'1'"), (1, "r_1_x_y", _ID), (2, "k", _ID))))
def q_flatten_mixed(spark, sf_dir):
    return SS.flatten_json(_mixed(spark, sf_dir), ["event_id"], "doc")


@register("payload_rejects",
          f"SELECT event_id, CAST(11 + length({_ID}) AS BIGINT) AS n_chars, true AS has_reason FROM events WHERE event_id % 4 = 3")
def q_payload_rejects(spark, sf_dir):
    rejects = SS.payload_rejects(_mixed(spark, sf_dir), ["event_id"], "doc")
    return rejects.select("event_id", "n_chars", (F.length("reason") > 0).alias("has_reason"))


@register("repeated_names_are_json",
          "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'txt' ELSE 'json' END AS format, CAST(1 AS BIGINT) AS records FROM events")
def q_repeated_names_are_json(spark, sf_dir):
    doc = F.col("doc")
    return _mixed(spark, sf_dir).select("event_id", FM.detect_by_content(doc).alias("format"), SS.record_count(doc).alias("records"))


def _delimited(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    two, kind = F.concat_ws("\t", "event_type", F.col("user_id").cast("string")), F.col("event_id") % 3
    body = (F.when(kind == 0, F.concat(two, F.lit("\n"), two))
            .when(kind == 1, F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(", 2, 3]"))))
    return ev.select("event_id", body.alias("body"))


@register("detect_tsv_json_bin",
          "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'tsv' WHEN 1 THEN 'json' ELSE 'bin' END AS format, "
          "CAST(CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS BIGINT) AS records FROM events")
def q_detect_tsv_json_bin(spark, sf_dir):
    body = F.col("body")
    return _delimited(spark, sf_dir).select("event_id", FM.detect_by_content(body).alias("format"), SS.record_count(body).alias("records"))


# How a page's host is spelled into an address, and whether that is a valid one.
_SPELLINGS = [("https://{}/x", True), ("HTTPS://{}", True), ("http://my_{}/a b/[day]?", True), ("http://u@{}", True), ("ftp://{}", False),
              ("//{}", False), ("http:///{}", False), ("mailto:{}", False), ("{}", False)]


@register("valid_urls_spelled",
          "SELECT page_id, spelling, valid AS is_valid_url FROM pages, (VALUES " +
          ", ".join(f"('{s}', {str(v).lower()})" for s, v in _SPELLINGS) + ") s(spelling, valid)")
def q_valid_urls_spelled(spark, sf_dir):
    pages = load_table(spark, sf_dir, "pages", ["page_id", "url"])
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    each = pages.select("page_id", host.alias("host"), F.explode(F.array(*[F.lit(s) for s, _ in _SPELLINGS])).alias("spelling"))
    url = F.replace(F.col("spelling"), F.lit("{}"), F.col("host"))
    return each.select("page_id", "spelling", SS.valid_url(url).alias("is_valid_url"))


@register("declared_format", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'yaml' ELSE 'txt' END AS format FROM documents")
def q_declared_format(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", ["doc_id"])
    said = F.when(F.col("doc_id") % 3 == 0, "YAML").when(F.col("doc_id") % 3 == 1, "what")
    return docs.select("doc_id", FM.declared_or_detected(said, F.lit("txt")).alias("format"))


@register("xml_records", "SELECT event_id, event_type FROM events")
def q_xml_records(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["event_id", "event_type"])
    xml = ev.select(SS.to_xml_record(ev, ["event_id", "event_type"]).alias("x"))
    return xml.select(F.from_xml("x", "event_id BIGINT, event_type STRING").alias("r")).select("r.event_id", "r.event_type")


@register("json_text", "SELECT event_id, event_type FROM events")
def q_json_text(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["event_id", "event_type"])
    text = ev.select(F.to_json(F.struct("event_id", "event_type")).alias("j"))
    return text.select(F.from_json("j", "event_id BIGINT, event_type STRING").alias("r")).select("r.event_id", "r.event_type")


# ---------------------------------------------------------------- sinks on real text

_TEXT_COLUMNS = {"documents": ("doc_id", "text", "source"), "pages": ("page_id", "url", "html")}


def _text_roundtrip(fmt, name):
    def run(spark, sf_dir):
        df = load_table(spark, sf_dir, name, list(_TEXT_COLUMNS[name]))
        path = scratch_path(spark, f"text-{fmt}-{name}")
        W.WRITERS[fmt](df, path)
        return read_back(spark, path, fmt, df.schema).select(*df.columns)
    return run


for _name, _columns in _TEXT_COLUMNS.items():
    for _fmt in ("csv", "tsv", "json", "parquet", "xml", "html"):
        register(f"roundtrip_{_fmt}_{_name}", f"SELECT {', '.join(_columns)} FROM {_name}")(_text_roundtrip(_fmt, _name))


@register("roundtrip_text", "SELECT text FROM documents")
def q_roundtrip_text(spark, sf_dir):
    path = scratch_path(spark, "payload-text")
    W.write_text(load_table(spark, sf_dir, "documents", ["text"]), path, "text")
    return read_back(spark, path, "text").select(F.col("value").alias("text"))


@register("roundtrip_bytes", "SELECT text FROM documents")
def q_roundtrip_bytes(spark, sf_dir):
    path = scratch_path(spark, "payload-bytes")
    W.write_payloads(load_table(spark, sf_dir, "documents", ["text"]), path, "text")
    return spark.read.parquet(path).select(F.col("text").cast("string").alias("text"))


@register("yaml_records",
          "SELECT '- n: ' || event_id || chr(10) || '  s: ''' || event_type || '''' || chr(10) || "
          "'  t: ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || chr(10) || '  x: \"a\\n' || user_id || '\"' AS value FROM events")
def q_yaml_records(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    return W.yaml_records(ev.select(F.col("event_id").alias("n"), F.col("event_type").alias("s"), F.col("ts").alias("t"),
                                    F.concat(F.lit("a\n"), F.col("user_id").cast("string")).alias("x")))


# ---------------------------------------------------------------- sources, layouts, listing, landing


@register("kwh_csv_source", "SELECT ts AS \"DateTime\", CAST(CAST(value AS DECIMAL(15, 1)) AS DOUBLE) AS \"kWh\" FROM events")
def q_kwh_csv_source(spark, sf_dir):
    path = scratch_path(spark, "kwh-csv")
    W.write_csv(load_kwh(spark, sf_dir), path)
    back = read_kwh_csv(spark, path)
    return back.select(F.col("DateTime").cast("timestamp_ntz").alias("DateTime"), F.col("kWh").cast("double").alias("kWh"))


@register("readings_json_source", O.with_(O.R) + "SELECT location_id, lmp_total, count(*) AS n FROM r GROUP BY location_id, lmp_total")
def q_readings_json_source(spark, sf_dir):
    path = scratch_path(spark, "readings-json")
    W.write_json(load_readings(spark, sf_dir).select("timestamp", "location_id", "lmp_total"), path)
    back = read_readings_json(spark, path, lines=True)
    return back.groupBy("location_id", F.col("lmp_total").cast("double").alias("lmp_total")).agg(F.count("*").alias("n"))


IDS_A_FILE = 10_000


def _land_files(spark, sf_dir, folder, part=None):
    """Events as landed files: a folder for each type, one indented JSON array a file, which holds
    a day's events of one range of ``IDS_A_FILE`` ids.  ``part`` is a condition on day and ids."""
    ev = load_table(spark, sf_dir, "events").withColumns({"day": F.to_date("ts"), "ids": F.expr(f"event_id div {IDS_A_FILE}")})
    record = F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("location_id"))
    files = (ev if part is None else ev.where(part)).groupBy("event_type", "day", "ids").agg(F.to_json(F.collect_list(record), {"pretty": "true"}).alias("value"))
    files = files.withColumn("api", F.concat(F.lit("Pull-"), "event_type")).repartition("api", "day", "ids")
    files.select("value", "api").write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", " ").partitionBy("api").text(folder)


def _landed(spark, sf_dir):
    root = scratch_path(spark, "landing")
    _land_files(spark, sf_dir, f"{root}/in")
    return root


@register("readings_json_arrays", "SELECT event_type AS location_id, count(*) AS n FROM events GROUP BY event_type")
def q_readings_json_arrays(spark, sf_dir):
    schema = "event_id string, location_id string"
    back = read_readings_json(spark, f"{_landed(spark, sf_dir)}/in/*", spark.createDataFrame([], schema).schema)
    return back.groupBy("location_id").agg(F.count("*").alias("n"))


@register("landing_log",
          "SELECT 'api=Pull-' || event_type AS api_name, 'api=pull-' || event_type AS folder_path, count(*) AS files, "
          "CAST(sum(n) AS BIGINT) AS records, count(*) AS uploaded "
          "FROM (SELECT event_type, count(*) AS n FROM events "
          f"GROUP BY event_type, CAST(ts AS DATE), event_id // {IDS_A_FILE}) GROUP BY event_type")
def q_landing_log(spark, sf_dir):
    root = _landed(spark, sf_dir)
    log = land_payloads(spark, f"{root}/in", f"{root}/out", declared="json").run_log
    return log.groupBy("api_name", "folder_path").agg(F.count("*").alias("files"), F.sum("record_count").alias("records"),
                                                      F.count_if(F.col("upload_status") == "success").alias("uploaded"))


@register("landing_records", "SELECT CAST(event_id AS VARCHAR) AS value FROM events")
def q_landing_records(spark, sf_dir):
    root = _landed(spark, sf_dir)
    run = land_payloads(spark, f"{root}/in", f"{root}/out", declared="json")
    return spark.read.parquet(run.records_path).where("key = 'event_id'").select("value")


@register("landing_manifest",
          "SELECT 'api=pull-' || event_type AS folder_path, count(*) AS files, CAST(sum(n) AS BIGINT) AS record_count "
          "FROM (SELECT event_type, count(*) AS n FROM events "
          f"GROUP BY event_type, CAST(ts AS DATE), event_id // {IDS_A_FILE}) GROUP BY event_type")
def q_landing_manifest(spark, sf_dir):
    root = _landed(spark, sf_dir)
    return land_payloads(spark, f"{root}/in", f"{root}/out", declared="json").manifest.select("folder_path", "files", "record_count")


@register("zone_filter",
          f"WITH r AS (SELECT CASE event_type {_ZONE_CASE} END AS location_id, event_id FROM events) "
          f"SELECT location_id, event_id FROM r WHERE location_id IN ({', '.join(repr(z) for z in LOAD_ZONES)})")
def q_zone_filter(spark, sf_dir):
    r = zone_coded_readings_from_events(load_table(spark, sf_dir, "events"))
    return r.filter(load_zone_filter()).select("location_id", "event_id")


@register("foldered_layout", "SELECT event_type AS source, count(*) AS n FROM events GROUP BY event_type")
def q_foldered_layout(spark, sf_dir):
    path = scratch_path(spark, "foldered")
    W.write_foldered(load_table(spark, sf_dir, "events", ["event_id", "event_type"]), path, "event_type", run_ts="r1")
    return spark.read.parquet(path).groupBy("source").agg(F.count("*").alias("n"))


@register("date_path_layout", "SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS n FROM events GROUP BY 1")
def q_date_path_layout(spark, sf_dir):
    path = scratch_path(spark, "date-path")
    W.write_date_path(load_table(spark, sf_dir, "events", ["event_id", "ts"]), path, "ts", "parquet")
    pad = [F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("year", 4), ("month", 2), ("day", 2))]
    return spark.read.parquet(path).groupBy(F.concat(*pad).alias("day")).agg(F.count("*").alias("n"))


@register("provenance", "SELECT event_id, 'events' AS api_name, 'run1' AS unique_id, true AS stamped FROM events")
def q_provenance(spark, sf_dir):
    out = W.with_provenance(load_table(spark, sf_dir, "events", ["event_id"]), "events", "run1")
    return out.select("event_id", "api_name", "unique_id", F.col("ingest_timestamp").isNotNull().alias("stamped"))


@register("listed_files", "SELECT 'parquet' AS detected_format, count(DISTINCT event_type) AS folders FROM events")
def q_listed_files(spark, sf_dir):
    path = scratch_path(spark, "listed")
    load_table(spark, sf_dir, "events").write.partitionBy("event_type").parquet(path)
    files = list_files(spark, path, "parquet")
    return files.groupBy("detected_format").agg(F.count_distinct(F.regexp_extract("key", "event_type=([^/]*)", 1)).alias("folders"))
