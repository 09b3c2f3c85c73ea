"""Registered queries on stored and approximate forms, and on data that meets the rules' rare cases:
sketches by day, values across sources, runs of missing intervals, publishing in one step, arrays read by
ranges, and kWh rows and readings with NULLs, signs and zeros.

All data comes from the given tables; the adapters here only make cases that they lack, and the
SQL states the same adapter.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltframe.functions import formats as FM
from voltframe.functions import semistructured as SS
from voltframe.functions.numeric import clip, loss_percentage
from voltframe.operators import sketches as SK
from voltframe.operators.duplicates import across_sources, across_sources_report
from voltframe.operators.gaps import missing_days, missing_runs
from voltframe.plans import kwh as KW
from voltframe.plans import oracle_sql as O
from voltframe.plans.catalog import _FLAT_SQL, _GRID, _ISO, _QUALITY, AS_OF, TIE_ORDER, _dec_as_double, _nested_docs, register
from voltframe.plans.enrich import enrich_readings
from voltframe.session import scratch_path
from voltframe.sinks import writers as W
from voltframe.sources.adapters import load_kwh, load_readings
from voltframe.sources.files import read_back
from voltframe.sources.json_ranges import read_json_arrays
from voltframe.sources.tables import load_table

# ---------------------------------------------------------------- sketches (AG8, AG13, AG15)

QUANTILES = {"median_kwh": 0.5, "p95_kwh": 0.95}
_ASKED = "(SELECT unnest([0.5, 0.95]) AS p)"
_MONTH = "strftime(DateTime, '%Y-%m')"
SLACK = 3          # times the sketch's own error at 99 %


@register("kwh_monthly_sketch", O.with_(O.K) + f"SELECT month, CAST(p AS DOUBLE) AS p, n, true AS within FROM "
          f"(SELECT {_MONTH} AS month, count(*) AS n FROM k GROUP BY ALL), {_ASKED}")
def q_kwh_monthly_sketch(spark, sf_dir):
    """Months merged from the stored sketches of days; the true rank of each estimate is in bounds."""
    kwh, path = load_kwh(spark, sf_dir), scratch_path(spark, "day-sketches")
    SK.daily_quantile_sketches(kwh, "kWh", "DateTime").write.parquet(path)
    months = spark.read.parquet(path).withColumn("month", F.date_format("day", "yyyy-MM"))
    found = SK.merged_quantiles(months, ["month"], QUANTILES)
    return SK.rank_bounds(kwh.withColumn("month", F.date_format("DateTime", "yyyy-MM")), found, ["month"], "kWh", QUANTILES, SLACK * SK.rank_error())


@register("kwh_trailing_sketch", O.with_(O.K) + "SELECT day, CAST(p AS DOUBLE) AS p, n, true AS within FROM "
          "(SELECT strftime(e.day, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT DISTINCT CAST(DateTime AS DATE) AS day FROM k) e "
          "JOIN k ON CAST(DateTime AS DATE) BETWEEN e.day - 6 AND e.day GROUP BY ALL), " + _ASKED)
def q_kwh_trailing_sketch(spark, sf_dir):
    """The seven days up to each day, merged from the sketches of days."""
    kwh = load_kwh(spark, sf_dir)
    found = SK.merged_quantiles(SK.trailing_windows(SK.daily_quantile_sketches(kwh, "kWh", "DateTime"), 7), ["day"], QUANTILES)
    ends = kwh.select(F.to_date("DateTime").alias("day")).distinct()
    rows = kwh.withColumn("day", F.explode(F.sequence(F.to_date("DateTime"), F.date_add(F.to_date("DateTime"), 6), F.expr("INTERVAL 1 DAY"))))
    out = SK.rank_bounds(rows.join(ends, "day", "left_semi"), found, ["day"], "kWh", QUANTILES, SLACK * SK.rank_error())
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("kwh_monthly_approx", O.with_(O.K) +
          f"SELECT {_MONTH} AS month, count(*) AS reading_count, {O.rnd('avg(CAST(kWh AS DOUBLE))', 4)} AS avg_kwh, "
          "CAST(sum(kWh) AS DOUBLE) AS total_kwh, CAST(min(kWh) AS DOUBLE) AS min_kwh, CAST(max(kWh) AS DOUBLE) AS max_kwh, "
          f"CAST(2 AS BIGINT) AS percentiles_in_bounds FROM k WHERE DateTime >= DATE '{AS_OF}' - INTERVAL 12 MONTH GROUP BY ALL")
def q_kwh_monthly_approx(spark, sf_dir):
    """The monthly report as it is asked for, with approximate percentiles."""
    kwh = load_kwh(spark, sf_dir)
    report = _dec_as_double(KW.monthly_trend(kwh, AS_OF, ordered=False))
    months = kwh.withColumn("month", F.date_format("DateTime", "yyyy-MM"))
    ranks = SK.rank_bounds(months, report, ["month"], "kWh", QUANTILES, 1.0 / KW.P_ACCURACY + 1e-9)
    good = ranks.groupBy("month").agg(F.count_if("within").alias("percentiles_in_bounds"))
    return report.drop(*QUANTILES).join(good, "month")


def _customers(spark, sf_dir):
    return {"billing": load_table(spark, sf_dir, "orders", ["o_custkey"]), "crm": load_table(spark, sf_dir, "customer", ["c_custkey"]),
            "events": load_table(spark, sf_dir, "events", ["user_id"])}


_SOURCES = ("s AS (SELECT o_custkey AS value, 'billing' AS source FROM orders UNION ALL SELECT c_custkey, 'crm' FROM customer "
            "UNION ALL SELECT user_id, 'events' FROM events)")


@register("values_across_sources", O.with_(_SOURCES) +
          "SELECT CAST(value AS VARCHAR) AS value, count(*) AS occurrences, count(DISTINCT source) AS n_sources, "
          "string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM s WHERE value IS NOT NULL GROUP BY value HAVING count(DISTINCT source) > 1")
def q_values_across_sources(spark, sf_dir):
    return across_sources(_customers(spark, sf_dir)).where("n_sources > 1").withColumn("sources", F.array_join("sources", ","))


@register("across_sources_report", O.with_(_SOURCES, "v AS (SELECT value, count(*) AS n, count(DISTINCT source) AS m FROM s WHERE value IS NOT NULL GROUP BY value)") +
          "SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS distinct_records, CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed, "
          "count(CASE WHEN m > 1 THEN 1 END) AS shared_values FROM v")
def q_across_sources_report(spark, sf_dir):
    return across_sources_report(across_sources(_customers(spark, sf_dir)))


@register("source_overlaps", O.with_(_SOURCES) +
          "SELECT a.source AS first, b.source AS second, true AS distinct_in_bounds, true AS overlap_in_bounds "
          "FROM (SELECT DISTINCT source FROM s) a JOIN (SELECT DISTINCT source FROM s) b ON a.source <= b.source")
def q_source_overlaps(spark, sf_dir):
    """Distinct sketches by source, their unions and overlaps, against the exact counts."""
    sources = _customers(spark, sf_dir)
    found = SK.distinct_estimates(SK.distinct_sketches(sources))
    exact = across_sources(sources).select(F.explode("sources").alias("first"), "sources").select("first", F.explode("sources").alias("second"))
    both = exact.where("first <= second").groupBy("first", "second").agg(F.count("*").alias("true_overlap"))
    alone = both.where("first = second")
    out = found.join(both, ["first", "second"], "left").join(alone.select("first", F.col("true_overlap").alias("n1")), "first").join(
        alone.select("second", F.col("true_overlap").alias("n2")), "second")
    same = F.coalesce("true_overlap", F.lit(0))
    union = F.when(F.col("first") == F.col("second"), same).otherwise(F.col("n1") + F.col("n2") - same)
    room = 4 * SK.distinct_error() * union + 1
    return out.select("first", "second", (F.abs(F.col("distinct") - union) <= room).alias("distinct_in_bounds"),
                      (F.abs(F.col("overlap") - same) <= 3 * room).alias("overlap_in_bounds"))


# ---------------------------------------------------------------- missing intervals as runs (JN5)


@register("missing_runs", O.with_(O.R, _GRID) +
          "SELECT location_id, min(timestamp) AS first, max(timestamp) AS last, count(*) AS intervals FROM (SELECT *, "
          "timestamp - INTERVAL 15 MINUTE * row_number() OVER (PARTITION BY location_id ORDER BY timestamp) AS island FROM m) GROUP BY location_id, island")
def q_missing_runs(spark, sf_dir):
    return missing_runs(missing_days(load_readings(spark, sf_dir)))


# ---------------------------------------------------------------- publishing in one step (SNK15), sorted sinks (SL1), labels (DT16)


@register("save_published", O.with_(O.R, O.D) +
          "SELECT count(*) AS table_rows, count(*) AS csv_rows, count(*) AS json_rows, count(*) AS metadata_records, "
          "CAST(0 AS BIGINT) AS published_before, CAST(1 AS BIGINT) AS published_after FROM d")
def q_save_published(spark, sf_dir):
    """A save whose third write fails publishes nothing; the same call again publishes all."""
    root, rows = scratch_path(spark, "published"), enrich_readings(load_readings(spark, sf_dir), order=TIE_ORDER).readings
    class DiskFull(Exception):
        pass

    def fails(df, path):
        raise DiskFull

    try:
        W.save_to_storage(rows, root, "20240130", run_id="r", json_writer=fails)
    except DiskFull:
        pass
    before = W.published(spark, root).count()
    paths = W.save_to_storage(rows, root, "20240130", run_id="r")
    shown = W.published(spark, root).where("newest")
    table = spark.read.parquet(paths["table"]).agg(F.count("*").alias("table_rows"))
    seen = table
    for name, frame in (("csv_rows", read_back(spark, paths["csv"], "csv")), ("json_rows", read_back(spark, paths["json"], "json"))):
        seen = seen.withColumn(name, F.lit(frame.count()))
    records = spark.read.json(paths["metadata"]).select("record_count").first()[0]
    return seen.withColumns({"metadata_records": F.lit(records).cast("long"), "published_before": F.lit(before).cast("long"),
                             "published_after": F.lit(shown.count()).cast("long")})


@register("sorted_sink", O.with_(O.R, O.D) +
          "SELECT location_id, count(*) AS lines, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS files_out_of_order FROM d WHERE location_id = '.Z.VIEW' GROUP BY ALL")
def q_sorted_sink(spark, sf_dir):
    """Lines of a sorted sink that come before a smaller one: none within a file, nor between files by name."""
    rows = enrich_readings(load_readings(spark, sf_dir), order=TIE_ORDER).readings.where("location_id = '.Z.VIEW'").select("timestamp", "location_id")
    path = scratch_path(spark, "sorted-sink")
    W.write_csv(W.sorted_for_sink(rows, ["timestamp", "location_id"]), path)
    # the ids of a file's lines grow, as a file is a range of the scan or several in order
    lines = spark.read.schema("timestamp timestamp_ntz, location_id string").option("header", True).csv(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"))
    before = F.lag("timestamp").over(Window.partitionBy("file").orderBy("place"))
    by_file = lines.withColumn("wrong", F.coalesce(before > F.col("timestamp"), F.lit(False))).groupBy("location_id", "file").agg(
        F.count("*").alias("n"), F.count_if("wrong").alias("wrong"), F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
    total = by_file.groupBy("location_id").agg(F.sum("n").alias("lines"), F.sum("wrong").alias("out_of_order"),
                                               F.array_sort(F.collect_list(F.struct("file", "low", "high"))).alias("files"))      # a row for each file
    pairs = F.arrays_zip(F.slice("files", 1, F.size("files") - 1).alias("a"), F.slice("files", 2, F.size("files")).alias("b"))
    return total.select("location_id", "lines", "out_of_order", F.size(F.filter(pairs, lambda p: p["a"]["high"] > p["b"]["low"])).cast("long").alias("files_out_of_order"))


@register("processing_labels", O.with_(O.R, O.D) + "SELECT location_id, '1.0' AS data_version, count(*) AS stamped FROM d GROUP BY location_id")
def q_processing_labels(spark, sf_dir):
    rows = enrich_readings(load_readings(spark, sf_dir), order=TIE_ORDER, processing_metadata=True).readings
    good = F.col("processing_timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$")
    return rows.groupBy("location_id", "data_version").agg(F.count_if(good).alias("stamped"))


# ---------------------------------------------------------------- arrays larger than a task (SRC2)


@register("readings_json_ranges",
          "SELECT CAST(event_id AS VARCHAR) AS event_id, '.Z.' || upper(event_type) AS location_id, "
          "'a}\"{\\, [' || event_id || chr(10) || ']' AS note, '}' || user_id AS inner_note FROM events")
def q_readings_json_ranges(spark, sf_dir):
    """One indented array a day and ten thousand ids, with braces, quotes and line ends inside texts."""
    ev = load_table(spark, sf_dir, "events")
    text = F.col("event_id").cast("string")
    record = F.struct(text.alias("event_id"), F.concat(F.lit(".Z."), F.upper("event_type")).alias("location_id"),
                      F.concat(F.lit("a}\"{\\, ["), text, F.lit("\n]")).alias("note"),
                      F.struct(F.concat(F.lit("}"), F.col("user_id").cast("string")).alias("inner")).alias("more"))
    files = ev.groupBy(F.to_date("ts").alias("day"), F.expr("event_id div 10000").alias("ids")).agg(F.to_json(F.collect_list(record), {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "json-arrays")
    files.repartition("day", "ids").select("value").write.option("maxRecordsPerFile", 1).option("lineSep", " ").text(path)
    empty = spark.createDataFrame([], "event_id string, location_id string, note string, more struct<inner: string>")
    return read_json_arrays(spark, path, empty.schema).select("event_id", "location_id", "note", F.col("more.inner").alias("inner_note"))


# ---------------------------------------------------------------- rows that meet the rules (AG12, PF4, MA4, MA5, SF8)

_ROUGH_K = ("k AS (SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS DateTime, "
            "CAST(CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN -value ELSE value END AS DECIMAL(15,1)) AS kWh FROM events)")
_K_DAY = "strftime(DateTime, '%Y-%m-%d')"


def _rough_kwh(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", None).when(F.col("event_type") == "click", -F.col("value")).otherwise(F.col("value"))
    return ev.select(F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("DateTime"), value.cast("decimal(15,1)").alias("kWh"))


@register("kwh_quality_rough", O.with_(_ROUGH_K) + _QUALITY + f"WHERE DateTime >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY {_K_DAY}")
def q_kwh_quality_rough(spark, sf_dir):
    return KW.quality(_rough_kwh(spark, sf_dir), AS_OF)


@register("kwh_quality_all_rough", O.with_(_ROUGH_K) + _QUALITY + f"GROUP BY {_K_DAY}")
def q_kwh_quality_all_rough(spark, sf_dir):
    return KW.quality_all(_rough_kwh(spark, sf_dir))


@register("kwh_view_rough", O.with_(_ROUGH_K) +
          f"SELECT DateTime, CAST(round(kWh, 1) AS DOUBLE) AS kWh_rounded, {_K_DAY} AS date_only, strftime(DateTime, '%H') AS hour_only, "
          "CASE WHEN strftime(DateTime, '%H') BETWEEN '06' AND '18' THEN 'Day' ELSE 'Night' END AS time_period FROM k WHERE DateTime IS NOT NULL")
def q_kwh_view_rough(spark, sf_dir):
    return _dec_as_double(KW.kwh_view(_rough_kwh(spark, sf_dir)))


_LOSS = "(event_id % 41 - 10) * 0.25"
_PRICE = "CASE WHEN event_id % 6 = 0 THEN 0.0 WHEN event_id % 6 = 1 THEN NULL WHEN event_id % 6 = 2 THEN -value ELSE (event_id % 13) * 1.0 END"


@register("loss_percentages", f"SELECT event_id, CASE WHEN lmp = 0 THEN CASE WHEN loss > 0 THEN 100.0 WHEN loss < 0 THEN 0.0 END "
          f"ELSE CASE WHEN loss / lmp IS NULL THEN NULL ELSE least(greatest({O.rnd('loss / lmp * 100', 2)}, 0.0), 100.0) END END AS loss_percentage, "
          f"CASE WHEN lmp IS NULL THEN NULL ELSE least(greatest(lmp, 2.0), 9.0) END AS clipped "
          f"FROM (SELECT event_id, CAST({_LOSS} AS DOUBLE) AS loss, CAST({_PRICE} AS DOUBLE) AS lmp FROM events)")
def q_loss_percentages(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["event_id", "value"])
    rows = ev.select("event_id", F.expr(f"CAST({_LOSS} AS DOUBLE)").alias("loss"), F.expr(f"CAST({_PRICE} AS DOUBLE)").alias("lmp"))
    return rows.select("event_id", loss_percentage(F.col("loss"), F.col("lmp")).alias("loss_percentage"), clip(F.col("lmp"), 2.0, 9.0).alias("clipped"))


@register("declared_over_detected",
          "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'yaml' ELSE CASE event_id % 3 WHEN 0 THEN 'tsv' WHEN 1 THEN 'json' ELSE 'html' END END AS format FROM events")
def q_declared_over_detected(spark, sf_dir):
    """A declared format wins if it is one; otherwise the content says."""
    ev = load_table(spark, sf_dir, "events", ["event_id", "event_type"])
    kind = F.col("event_id") % 3
    row = F.concat_ws("\t", "event_type", F.col("event_id").cast("string"))
    body = F.when(kind == 0, F.concat(row, F.lit("\n"), row)).when(kind == 1, F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit("}"))) \
        .otherwise(F.concat(F.lit("<!DOCTYPE html><html><body>"), "event_type", F.lit("</body></html>")))
    said = F.when(F.col("event_id") % 4 == 0, "YAML").when(F.col("event_id") % 4 == 1, "what").when(F.col("event_id") % 4 == 2, "")
    return ev.select("event_id", FM.declared_or_detected(said, FM.detect_by_content(body, html_first=True)).alias("format"))


# ---------------------------------------------------------------- unknown payloads as XML, records as JSON text (SF4, SF7)


def _payload_docs(events):
    """JSON texts with names that hold ' ' and '-', lists in lists, markup in texts, and empty values."""
    doc = F.struct(
        F.col("event_id").alias("event id"), F.struct(F.col("user_id").alias("user-id"), F.concat(F.lit("<&> "), "event_type").alias("the type")).alias("meta-data"),
        F.array(F.array(F.col("event_id"), F.col("user_id")), F.array(F.col("user_id"))).alias("list"),
        F.lit(None).cast("string").alias("none"), (F.col("event_id") % 2 == 0).alias("flag"), F.array().cast("array<string>").alias("empty"))
    return events.select("event_id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))


@register("json_to_xml",
          "SELECT event_id AS id, event_id, user_id, '<&> ' || event_type AS the_type, event_id AS first_of_first, user_id AS second_of_first, "
          "user_id AS first_of_second, 'None' AS none, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS flag, true AS has_empty FROM events")
def q_json_to_xml(spark, sf_dir):
    xml = SS.json_to_xml(_payload_docs(load_table(spark, sf_dir, "events")), ["event_id"], "doc")
    shape = ("event_id BIGINT, meta_data STRUCT<user_id: BIGINT, the_type: STRING>, list STRUCT<item_0: STRUCT<item_0: BIGINT, item_1: BIGINT>, "
             "item_1: STRUCT<item_0: BIGINT>>, none STRING, flag STRING")
    r = xml.select(F.col("event_id").alias("id"), F.from_xml("xml", shape).alias("r"), F.contains("xml", F.lit("<empty />")).alias("has_empty"))
    return r.select("id", "r.event_id", "r.meta_data.user_id", "r.meta_data.the_type", F.col("r.list.item_0.item_0").alias("first_of_first"),
                    F.col("r.list.item_0.item_1").alias("second_of_first"), F.col("r.list.item_1.item_0").alias("first_of_second"), "r.none", "r.flag", "has_empty")


@register("json_text_kinds",
          "SELECT event_id, '{\"event_id\":' || event_id || ',\"at\":\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || "
          "CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END || "
          "'\",\"hour\":\"' || strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') || '\",\"day\":\"' || strftime(ts, '%Y-%m-%d') || "
          "'\",\"amount\":\"' || CAST(value AS DECIMAL(12,2)) || '\",\"none\":null,\"in\":{\"days\":[\"' || strftime(ts, '%Y-%m-%d') || '\"]}}' AS text FROM events")
def q_json_text_kinds(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    rows = ev.select("event_id", F.col("ts").alias("at"), F.date_trunc("hour", "ts").alias("hour"), F.to_date("ts").alias("day"),
                     F.col("value").cast("decimal(12,2)").alias("amount"), F.lit(None).cast("string").alias("none"),
                     F.struct(F.array(F.to_date("ts")).alias("days")).alias("in"))
    return rows.select("event_id", SS.json_text(rows).alias("text"))


# ---------------------------------------------------------------- unknown JSON as a wide frame (SF3)


@register("flatten_json_wide",
          "SELECT event_id, CAST(event_id AS VARCHAR) AS id, event_type AS meta_type, CAST(user_id AS VARCHAR) AS meta_user, "
          f"strftime(ts, {_ISO}) AS readings_0_ts, CAST(value AS VARCHAR) AS readings_0_value, strftime(date_trunc('hour', ts), {_ISO}) AS readings_1_ts, "
          "CAST(value * 2 AS VARCHAR) AS readings_1_value, CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS props_k FROM events")
def q_flatten_json_wide(spark, sf_dir):
    return SS.flatten_json_wide(_nested_docs(load_table(spark, sf_dir, "events")), ["event_id"], "doc")


@register("flatten_long_native", _FLAT_SQL)
def q_flatten_long_native(spark, sf_dir):
    """The long form without a Python worker."""
    return SS.flatten_json(_nested_docs(load_table(spark, sf_dir, "events")), ["event_id"], "doc", native=True)
