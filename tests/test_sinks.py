"""Sink formats, layouts, upsert and listing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltframe.session import scratch_path
from voltframe.sinks import writers as W
from voltframe.sources.files import list_files, read_back, read_kwh_csv, read_payloads

F4 = [("2025-06-24 10:00:00", 1250.5, "Northeast"), ("2025-06-24 11:00:00", 1180.3, "Northeast")]


def _frame(spark):
    return spark.createDataFrame(F4, "timestamp string, energy_consumption double, region string")


def test_yaml_and_html(spark):
    df = _frame(spark)
    y = [r[0] for r in W.yaml_records(df).collect()]
    assert y[0] == "- energy_consumption: 1250.5\n  region: 'Northeast'\n  timestamp: '2025-06-24 10:00:00'"
    typed = spark.createDataFrame([(1, True, None, 1e20, dt.date(2024, 1, 2))], "n int, b boolean, s string, f double, d date")
    assert W.yaml_records(typed).first()[0] == "- b: true\n  d: 2024-01-02\n  f: 1.0e+20\n  n: 1\n  s: null"


def test_yaml_loads_back(spark):
    import yaml
    rows = [(1, "it's", 2.5, True, dt.date(2024, 1, 2)), (2, None, -1e-07, False, None), (3, "x: y", 1e20, None, None)]
    df = spark.createDataFrame(rows, "n int, s string, f double, b boolean, d date")
    text = "\n".join(r[0] for r in W.yaml_records(df).orderBy(F.col("value")).collect())
    loaded = sorted(yaml.safe_load(text), key=lambda r: r["n"])
    assert loaded == [dict(zip(["n", "s", "f", "b", "d"], r)) for r in rows]
    h = W.html_rows(spark.createDataFrame([("a<b", 1)], "x string, y int")).first()[0]
    assert h == "<tr><td>a&lt;b</td><td>1</td></tr>"


def test_foldered_name_rule():
    p = W.foldered_path("root", "Hourly DA LMP Final", None, "csv", dt.datetime(2025, 7, 2, 14, 30, 25), "ab12cd34")
    assert p == "root/hourly_da_lmp_final/energy_data_20250702_143025_ab12cd34.csv"


def test_layouts_and_listing(spark):
    root = scratch_path(spark, "layout")
    df = W.with_provenance(_frame(spark), "Morning Report", "run00001")
    W.write_foldered(df, f"{root}/folders", fmt="csv", run_ts="20250101_000000")
    assert os.path.isdir(f"{root}/folders/source=morning_report/run_ts=20250101_000000".replace("file:", ""))
    kwh = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), 1.5)], "DateTime timestamp_ntz, kWh double")
    W.write_date_path(kwh, f"{root}/dates")
    assert read_back(spark, f"{root}/dates", "csv").count() == 1
    files = list_files(spark, f"{root}/folders", "csv")
    assert files.count() >= 1 and files.filter(F.col("size") > 0).count() >= 1


def test_kwh_csv_source(spark):
    root = scratch_path(spark, "kwhcsv")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/energy_data.csv", "w") as f:
        f.write("DateTime,kWh\n2024-01-01 00:00:00,1.25\n2024-01-01 01:00:00,\n")
    rows = read_kwh_csv(spark, root).collect()
    assert [str(r["kWh"]) for r in rows] == ["1.3", "None"]


def test_landing_scan(spark):
    root = scratch_path(spark, "landing")
    os.makedirs(root, exist_ok=True)
    for name, body in [("a.json", '{"x": 1}'), ("b", "a\tb\nc\td"), ("c", "<root/>"), ("d.yml", "k: v")]:
        with open(f"{root}/{name}", "w") as f:
            f.write(body)
    got = {os.path.basename(r["path"]): r["format"] for r in read_payloads(spark, root).collect()}
    assert got == {"a.json": "json", "b": "tsv", "c": "xml", "d.yml": "yaml"}


def test_upsert_idempotent(spark):
    path = scratch_path(spark, "upsert-idem")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), "A", 1.0, "2024-01-01"),
                                (dt.datetime(2024, 1, 2, 0, 0), "A", 2.0, "2024-01-02")],
                               "timestamp timestamp_ntz, location_id string, lmp_total double, date string")
    first = sorted(map(tuple, W.upsert(df, path).collect()))
    second = sorted(map(tuple, W.upsert(df, path).collect()))
    assert first == second and len(first) == 2
    newer = df.filter("date = '2024-01-02'").withColumn("lmp_total", F.lit(9.0))
    got = {r["date"]: r["lmp_total"] for r in W.upsert(newer, path).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 9.0}


def test_landing_pipeline(spark):
    from voltframe.plans.landing import land_payloads
    root = scratch_path(spark, "pl4")
    os.makedirs(f"{root}/in/Morning Report", exist_ok=True)
    os.makedirs(f"{root}/in/iso_ne_fuel_mix", exist_ok=True)
    with open(f"{root}/in/Morning Report/a.json", "w") as f:
        f.write('[{"q": 1}, {"q": 2}]')
    with open(f"{root}/in/iso_ne_fuel_mix/b.csv", "w") as f:
        f.write("a,b\n1,2\n3,4")
    run = land_payloads(spark, f"{root}/in", f"{root}/out", run_ts="20250101_000000")
    log = {r["api_name"]: r for r in run.run_log.collect()}
    assert log["Morning Report"]["record_count"] == 2 and log["Morning Report"]["data_format"] == "json"
    assert log["Morning Report"]["folder_path"] == "iso_ne_morning_report"
    assert log["iso_ne_fuel_mix"]["record_count"] == 3 and log["iso_ne_fuel_mix"]["data_format"] == "csv"
    a = run.audit.first()
    assert (a["total_apis"], a["successful_uploads"], a["collection_success_rate"]) == (2, 2, 1.0)
    recs = spark.read.parquet(run.records_path)
    assert sorted(r["value"] for r in recs.collect()) == ["1", "2"]


def test_save_to_storage(spark):
    from voltframe.plans.enrich import enrich_readings
    from voltframe.schemas import READING_TEXT
    rows = [("2025-06-04T10:00:00Z", ".Z.MAINE", "Maine", "45.5", "40.0", "3.5", "2.0", "2025-06-04T10:05:00Z")]
    enriched = enrich_readings(spark.createDataFrame(rows, READING_TEXT)).readings
    paths = W.save_to_storage(enriched, scratch_path(spark, "snk15"), "20250604")
    assert set(paths) == {"table", "csv", "json", "metadata", "rows"}
    assert read_back(spark, paths["json"], "json").count() == 1
    meta = read_back(spark, paths["metadata"], "json").first()
    assert meta["record_count"] == 1 and meta["locations"] == [".Z.MAINE"]
    assert meta["price_summary"]["avg_lmp"] == 45.5 and meta["data_quality"]["total_hours"] == 1


def test_manifest_counts_in_write_pass(spark):
    df = _frame(spark)
    m = W.write_with_manifest(df, scratch_path(spark, "man"), "json").first()
    assert (m["record_count"], m["columns"], m["column_names"]) == (2, 3, "timestamp,energy_consumption,region")
    assert m["file_size_bytes"] > 0


def test_readings_json_source(spark):
    from voltframe.sources.files import read_readings_json
    root = scratch_path(spark, "src2")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/r.json", "w") as f:
        f.write('{"timestamp": "2025-06-04T10:00:00Z", "location_id": ".Z.MAINE", "lmp_total": 45.5}\n')
    r = read_readings_json(spark, root, lines=True).first()
    assert r["lmp_total"] == "45.5" and r["location_name"] is None


def test_stream_exactly_once(spark):
    from voltframe.streaming.ingest import read_landing_stream, run_available_now
    root = scratch_path(spark, "str1")
    os.makedirs(f"{root}/in", exist_ok=True)
    schema = "v long"
    spark.createDataFrame([(1,), (2,)], schema).write.mode("append").parquet(f"{root}/in")
    s = read_landing_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema)
    run_available_now(s, f"{root}/out", f"{root}/ck")
    run_available_now(s, f"{root}/out", f"{root}/ck")          # nothing new: no duplicates
    assert spark.read.parquet(f"{root}/out").count() == 2
    spark.createDataFrame([(3,)], schema).write.mode("append").parquet(f"{root}/in")
    run_available_now(s, f"{root}/out", f"{root}/ck")
    assert sorted(r["v"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


def test_stream_drops_rows_later_than_watermark(spark):
    from voltframe.streaming.ingest import hourly_stream, read_landing_stream, run_available_now
    root = scratch_path(spark, "late")
    schema = "timestamp timestamp, location_id string, lmp_total double, energy_component double, " \
             "congestion_component double, loss_component double"
    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in")
    land([(dt.datetime(2024, 1, 1, 10, 0), "A", 1.0, 1.0, 1.0, 1.0),
          (dt.datetime(2024, 1, 1, 14, 0), "A", 2.0, 1.0, 1.0, 1.0)])
    s = read_landing_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema)
    run_available_now(hourly_stream(s), f"{root}/out", f"{root}/ck")
    land([(dt.datetime(2024, 1, 1, 10, 30), "A", 100.0, 1.0, 1.0, 1.0),   # late: watermark is 13:00
          (dt.datetime(2024, 1, 1, 16, 0), "A", 3.0, 1.0, 1.0, 1.0)])
    run_available_now(hourly_stream(s), f"{root}/out", f"{root}/ck")
    out = {r["hour"].hour: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert out[10]["lmp_total_count_hourly"] == 1 and out[10]["lmp_total_mean_hourly"] == 1.0
    assert 14 in out and 16 not in out          # 16:00 is still open


def test_kwh_table_and_view_sql(spark):
    from voltframe.plans.kwh import register_kwh_table, register_kwh_view
    root = scratch_path(spark, "kwhtable")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/part.csv", "w") as f:
        f.write("DateTime,kWh\n2024-01-01 05:30:00,1.0\n2024-01-01 18:59:00,2.0\n,3.0\n")
    register_kwh_table(spark, root, "energy_data_t")
    view = register_kwh_view(spark, spark.table("energy_data_t"), "energy_data_view_t")
    got = sorted((r["hour_only"], r["time_period"]) for r in spark.sql("SELECT * FROM energy_data_view_t").collect())
    assert got == [("05", "Night"), ("18", "Day")] and view.count() == 2


def test_pull_window(spark):
    from voltframe.functions.timefields import pull_window
    r = spark.range(1).select(pull_window(F.lit(dt.date(2025, 3, 1))).alias("w")).first()["w"]
    assert (r["start"], r["end"]) == ("20250228", "20250301")


def test_enrich_stream_upserts_each_batch(spark):
    from voltframe.schemas import READING_TEXT
    from voltframe.streaming.ingest import enrich_stream_to_table, read_landing_stream
    root = scratch_path(spark, "pl1stream")
    os.makedirs(f"{root}/in", exist_ok=True)
    def land(name, rows):
        import json
        with open(f"{root}/in/{name}.json", "w") as f:
            for r in rows:
                f.write(json.dumps(dict(zip(READING_TEXT.fieldNames(), r))) + "\n")
    land("a", [("2025-06-04T10:00:00Z", ".Z.MAINE", "Maine", "45.5", "40", "3.5", "2", "2025-06-04T10:05:00Z")])
    s = read_landing_stream(spark, f"{root}/in", READING_TEXT, fmt="json")
    enrich_stream_to_table(s, f"{root}/table", f"{root}/ck")
    land("b", [("2025-06-04T10:00:00Z", ".Z.MAINE", "Maine", "50.0", "40", "3.5", "2", "2025-06-04T10:06:00Z"),
               ("2025-06-04T10:15:00Z", ".Z.MAINE", "Maine", "46.2", "40.5", "3.7", "2", "2025-06-04T10:20:00Z")])
    enrich_stream_to_table(s, f"{root}/table", f"{root}/ck")
    got = {r["minute_of_hour"]: r["lmp_total"] for r in spark.read.parquet(f"{root}/table").collect()}
    assert got == {0: 50.0, 15: 46.2}        # the re-pulled 10:00 reading replaced the first one


def test_f11_frame_round_trips_every_format(spark):
    regions = ["North", "South", "East", "West"]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + 9.0 * i, -10.0 + 0.45 * i, regions[i % 4])
            for i in range(100)]
    schema = "date date, energy_consumption double, temperature double, region string"
    df = spark.createDataFrame(rows, schema)
    for fmt in ("csv", "tsv", "json", "parquet", "xml"):
        path = scratch_path(spark, f"f11-{fmt}")
        W.WRITERS[fmt](df, path)
        back = read_back(spark, path, fmt, df.schema).select(*df.columns)
        assert sorted(map(tuple, back.collect())) == sorted(rows), fmt


def test_save_data_naming_and_manifest(spark):
    root = scratch_path(spark, "savedata")
    m = W.save_data(_frame(spark), root, "demand", folder_path="/iso_out/", when=dt.datetime(2025, 7, 2, 14, 30, 25),
                    manifest_path=f"{root}/_manifest").first()
    assert m["path"] == f"{root}/iso_out/demand_20250702_143025.csv" and m["record_count"] == 2
    assert spark.read.parquet(f"{root}/_manifest").count() == 1
    m2 = W.save_data(_frame(spark), root, "plain", data_format="JSON", include_timestamp=False).first()
    assert m2["path"] == f"{root}/plain.json" and m2["data_format"] == "json"


def test_manifest_metadata_and_audit_label(spark):
    from voltframe.operators.audit import ingest_audit
    m = W.write_with_manifest(_frame(spark), scratch_path(spark, "meta"), "csv",
                              metadata={"api_name": "Morning Report", "data_source": "api_collector"}).first()
    assert m["metadata"] == {"api_name": "Morning Report", "data_source": "api_collector"}
    log = spark.createDataFrame([("r1", "a", "success", "success", dt.datetime(2024, 1, 1))],
                                "run_id string, api_name string, collection_status string, upload_status string, "
                                "timestamp timestamp")
    a = ingest_audit(log, label="Northeast").first()
    assert a["region"] == "Northeast" and a["upload_success_rate"] == 1.0


def test_save_to_storage_empty_batch(spark):
    from voltframe.plans.enrich import enrich_readings
    from voltframe.schemas import READING_TEXT
    empty = enrich_readings(spark.createDataFrame([], READING_TEXT)).readings
    assert W.save_to_storage(empty, scratch_path(spark, "snk15-empty"), "20250604") == {}


TRICKY = ['a "q" b,c', " both ends ", "x\ny\r\nz", "", None, "tab\tx\\y\\", "cr\rx", '"', '\\"', "é\u2028 z", "#c", "<td>&amp;</td>", "it's: - x", "null"]


def test_text_round_trips_unchanged(spark):
    df = spark.createDataFrame([(i, t, dt.datetime(2024, 1, 2, 3, 4, 5, 678901)) for i, t in enumerate(TRICKY)], "i int, t string, at timestamp_ntz")
    for fmt in ("csv", "tsv", "json", "parquet", "html"):
        path = scratch_path(spark, f"tricky-{fmt}")
        W.WRITERS[fmt](df, path)
        got = {r["i"]: (r["t"], r["at"]) for r in read_back(spark, path, fmt, df.schema).collect()}
        want = {r["i"]: (None if fmt == "html" and r["t"] == "" else r["t"], r["at"]) for r in df.collect()}
        assert got == want, fmt


def test_html_parts_are_whole_tables(spark):
    path = scratch_path(spark, "html-parts")
    W.write_html(spark.createDataFrame([(1, "a"), (2, "b")], "`n<` int, s string").repartition(2), path)
    texts = [r["value"] for r in spark.read.text(path, wholetext=True).collect()]
    assert texts and all(t.startswith("<table><thead><tr><th>n&lt;</th>") and t.rstrip().endswith("</tbody></table>") for t in texts)


def test_yaml_keeps_line_ends_and_microseconds(spark):
    import yaml
    rows = [(i, t, dt.datetime(2024, 1, 2, 3, 4, 5, 678901)) for i, t in enumerate(TRICKY)]
    df = spark.createDataFrame(rows, "i int, t string, at timestamp_ntz")
    loaded = yaml.safe_load("\n".join(r[0] for r in W.yaml_records(df).collect()))
    assert sorted((r["i"], r["t"], r["at"]) for r in loaded if r["t"] is not None) == [r for r in rows if r[1] is not None]


def test_indented_arrays_are_read(spark):
    from voltframe.sources.files import read_readings_json
    root = scratch_path(spark, "indented")
    os.makedirs(root)
    with open(f"{root}/a.json", "w") as f:
        f.write('[\n  {"timestamp": "2025-01-01T00:00:00", "location_id": "A", "lmp_total": 1.5},\n  {"location_id": "B"}\n]')
    assert sorted(r["location_id"] for r in read_readings_json(spark, root).collect()) == ["A", "B"]


def test_binary_payloads_land_as_they_are(spark):
    from voltframe.plans.landing import land_payloads
    root = scratch_path(spark, "binary")
    os.makedirs(f"{root}/in/some api")
    raw = bytes(range(256))
    with open(f"{root}/in/some api/x", "wb") as f:
        f.write(raw)
    with open(f"{root}/in/some api/bad.json", "w") as f:
        f.write("{")
    run = land_payloads(spark, f"{root}/in", f"{root}/out", run_ts="r1")
    log = {os.path.basename(r["s3_key"]): (r["data_format"], r["upload_status"]) for r in run.run_log.collect()}
    assert log == {"x": ("bin", "success"), "bad.json": ("json", "success")}
    stored = {os.path.basename(r["path"]): bytes(r["content"]) for r in spark.read.parquet(run.raw_path).collect()}
    assert stored["x"] == raw and run.rejects.count() == 1 and run.manifest.first()["files"] == 2


def test_a_landing_run_that_is_tried_again_replaces_itself(spark):
    from voltframe.plans.landing import committed, land_payloads
    root = scratch_path(spark, "retried")
    os.makedirs(f"{root}/in/api")
    with open(f"{root}/in/api/a.json", "w") as f:
        f.write('[{"q": 1}, {"q": 2}]')
    for _ in range(2):
        run = land_payloads(spark, f"{root}/in", f"{root}/out", run_ts="20250101_000000", run_id="007")
    assert run.run_log.first()["run_id"] == "007" and run.run_log.count() == 1 and run.manifest.first()["record_count"] == 2
    assert [committed(spark, f"{root}/out", t).count() for t in ("raw", "records", "run_log", "manifest")] == [1, 2, 1, 1]
    land_payloads(spark, f"{root}/in", f"{root}/out", run_ts="20250101_000000")        # the same second, another run
    assert committed(spark, f"{root}/out", "records").count() == 4


def test_a_landing_batch_that_fails_shows_nothing_and_is_replayed_once(spark, monkeypatch):
    from voltframe.plans import landing
    root = scratch_path(spark, "replayed")
    os.makedirs(f"{root}/in/api")

    def put(name, text):
        with open(f"{root}/in/api/{name}", "w") as f:
            f.write(text)

    def go(checkpoint="c"):
        landing.land_new(spark, f"{root}/in", f"{root}/out", f"{root}/{checkpoint}")

    def counts():
        return [landing.committed(spark, f"{root}/out", t).count() for t in ("raw", "records", "run_log", "manifest")]

    put("a.json", '[{"q": 1}, {"q": 2}]')
    go()
    assert counts() == [1, 2, 1, 1]
    put("b.json", '{"q": 3}')
    real, calls = landing._replace, []

    def third_write_fails(df, path, *by):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("disk full")
        real(df, path, *by)

    monkeypatch.setattr(landing, "_replace", third_write_fails)
    with pytest.raises(Exception, match="disk full"):
        go()
    assert counts() == [1, 2, 1, 1]
    monkeypatch.setattr(landing, "_replace", real)
    go()
    assert counts() == [2, 3, 2, 2]
    go()
    go("another checkpoint")
    got = {(r["s3_key"].rsplit("/")[-1], r["upload_status"]) for r in landing.committed(spark, f"{root}/out", "run_log").collect()}
    assert counts()[:2] == [2, 3] and got == {(f, s) for f in ("a.json", "b.json") for s in ("success", "skipped")}


def test_python_workers_get_long_payloads_a_few_at_a_time(spark):
    import pyarrow as pa

    from voltframe.functions.semistructured import payload_rows
    payloads = spark.range(0, 60, 1, 1).select("id", F.expr("concat('[\"', repeat('x', 1000000), '\", ', id, ', null]')").alias("t"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    got = [r["n"] for r in payloads.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 60_000_000 and max(got) <= 16 << 20
    rows = payload_rows(payloads.union(spark.createDataFrame([(60, None), (61, "[")], "id long, t string")), ["id"], "t").where("record > 0")
    assert sorted((r["id"], r["record"], r["value"]) for r in rows.collect()) == [
        x for i in range(60) for x in ((i, 1, str(i)), (i, 2, None))]


def test_landed_records_are_written_without_sorting_them(spark, monkeypatch):
    from voltframe.plans import landing
    root, writers = scratch_path(spark, "unsorted"), "spark.sql.maxConcurrentOutputFileWriters"
    for i in range(10):                                    # more sources than files are open at once
        os.makedirs(f"{root}/in/api{i}")
        with open(f"{root}/in/api{i}/a.json", "w") as f:
            f.write(f'[{{"q": {i}}}, {{"q": null}}, {i}]')
    real, seen = landing._replace, {}

    def spy(df, path, *by):
        seen[os.path.basename(path)] = int(spark.conf.get(writers))
        real(df.coalesce(1), path, *by)

    monkeypatch.setattr(landing, "_replace", spy)
    before = [spark.conf.get(k, None) for k in landing.OPEN_FILES]
    run = landing.land_payloads(spark, f"{root}/in", f"{root}/out")
    assert seen["records"] > 1 and seen["raw"] == 0
    assert [spark.conf.get(k, None) for k in landing.OPEN_FILES] == before
    got = spark.read.parquet(run.records_path).select("source", "record", "key", "value").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [x for i in range(10) for x in ((f"api{i}", 0, "q", str(i)), (f"api{i}", 1, "q", None), (f"api{i}", 2, "value", str(i)))], key=str)


def test_upsert_keeps_what_the_batch_does_not_touch(spark):
    path = scratch_path(spark, "upsert-keeps")
    schema = "timestamp timestamp_ntz, location_id string, w double, v double, date string"
    t = dt.datetime(2024, 1, 1)
    W.upsert(spark.createDataFrame([(t, "A", 1.0, 1.0, None), (t, "B", 2.0, 2.0, None), (t, "C", 3.0, 3.0, "007"), (t, "C", 9.0, 9.0, "007")], schema), path)
    out = W.upsert(spark.createDataFrame([(t, "B", 5.0, None, 1), (t, "D", 6.0, "", 2)], "timestamp timestamp_ntz, location_id string, v double, date string, extra int"), path)
    got = {r["location_id"]: (r["w"], r["v"], r["date"], r["extra"]) for r in out.collect()}
    assert got == {"A": (1.0, 1.0, None, None), "B": (2.0, 5.0, None, 1), "C": (3.0, 3.0, "007", None), "D": (None, 6.0, None, 2)}


def test_an_upsert_opens_touched_partitions_only(spark):
    path = scratch_path(spark, "upsert-touched")
    schema = "timestamp timestamp_ntz, location_id string, v double, date string"
    t = dt.datetime(2024, 1, 1)
    W.upsert(spark.createDataFrame([(t, "A", 1.0, "d1"), (t, "B", 2.0, "d2")], schema), path)
    (broken,) = [f"{path}/date=d2/{f}" for f in os.listdir(f"{path}/date=d2") if f.endswith(".parquet")]
    crc = os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(broken, "wb") as f:
        f.write(b"no parquet at all")
    out = W.upsert(spark.createDataFrame([(t, "A", 5.0, "d1", 7)], schema + ", extra int"), path)
    assert [(r["location_id"], r["v"], r["extra"]) for r in out.where("date = 'd1'").collect()] == [("A", 5.0, 7)]
    assert out.columns == ["timestamp", "location_id", "v", "extra", "date"]


def test_a_table_without_a_stored_schema_gets_one(spark):
    path = scratch_path(spark, "upsert-old")
    for i, extra in enumerate(("", ", w int")):
        row = (dt.datetime(2024, 1, 1), f"L{i}", 1.0, "d", *([3] if extra else []))
        spark.createDataFrame([row], f"timestamp timestamp_ntz, location_id string, v double, date string{extra}").write.mode("append").partitionBy("date").parquet(path)
    out = W.upsert(spark.createDataFrame([(dt.datetime(2024, 1, 1), "L0", 9.0, "d")], "timestamp timestamp_ntz, location_id string, v double, date string"), path)
    assert sorted((r["location_id"], r["v"], r["w"]) for r in out.collect()) == [("L0", 9.0, None), ("L1", 1.0, 3)]
    assert os.path.exists(f"{path}/{W.SCHEMA_FILE}")


def test_saves_of_one_date_publish_the_newest(spark):
    from voltframe.plans.enrich import enrich_readings
    from voltframe.schemas import READING_TEXT
    root, rows = scratch_path(spark, "published"), [("2025-06-04T10:00:00Z", ".Z.MAINE", "Maine", "45.5", "40.0", "3.5", "2.0", "2025-06-04T10:05:00Z")]
    enriched = enrich_readings(spark.createDataFrame(rows, READING_TEXT)).readings
    assert W.published(spark, root).count() == 0

    def fails(df, path):
        raise OSError("disk full")

    with pytest.raises(OSError):
        W.save_to_storage(enriched, root, "20250604", json_writer=fails)
    assert W.published(spark, root).count() == 0 and not os.path.exists(f"{root}/lmp_data")
    first, second = (W.save_to_storage(enriched, root, "20250604", run_id=r) for r in ("one", "two"))
    W.save_to_storage(enriched, root, "20250604", run_id="two")
    got = {r["run_id"]: r["newest"] for r in W.published(spark, root).collect()}
    assert got == {"one": False, "two": True} and first["csv"] != second["csv"]
    assert W.save_to_storage(enriched.where("false"), root, "20250605") == {}


def test_genmix_files(spark):
    from voltframe.sources.genmix import read_genmix, transform_kwh
    root = scratch_path(spark, "genmix-files")
    os.makedirs(root)
    for i, offset in enumerate(("-04:00", "-05:00")):      # the hour that a clock set back shows twice
        with open(f"{root}/{i}.json", "w") as f:
            f.write('{"GenMixes": [{"GenMixs": [\n{"BeginDate": "2024-11-03T01:30:00%s", "GenMw": "1.5"}]}]}' % offset)
    assert sorted(str(r["DateTime"]) for r in transform_kwh(read_genmix(spark, root)).collect()) == ["2024-11-03 05:30:00", "2024-11-03 06:30:00"]


def test_an_hour_in_two_batches_gets_the_statistics_of_both(spark):
    from voltframe.schemas import READING_TEXT
    from voltframe.streaming.ingest import enrich_stream_to_table, read_landing_stream
    root = scratch_path(spark, "two-batches")

    def land(minute, price):
        row = (f"2025-06-04T10:{minute}:00Z", ".Z.MAINE", "Maine", price, "1.0", "0.0", "0.0", "2025-06-04T11:00:00Z")
        spark.createDataFrame([row], READING_TEXT).write.mode("append").parquet(f"{root}/in")
        enrich_stream_to_table(read_landing_stream(spark, f"{root}/in", READING_TEXT), f"{root}/table", f"{root}/ck")
    land("00", "10.0")
    land("15", "20.0")
    rows = spark.read.parquet(f"{root}/table").collect()
    assert sorted((r["lmp_total"], r["lmp_total_mean_hourly"], r["lmp_total_count_hourly"]) for r in rows) == [(10.0, 15.0, 2), (20.0, 15.0, 2)]


def test_landed_files_of_a_hot_type_and_day_are_bounded(spark, monkeypatch):
    from voltframe.plans import rules_catalog as R
    ids = F.when(F.col("id") % 5 == 0, F.lit("view")).otherwise("click")
    ev = spark.range(25_000).select(F.col("id").alias("event_id"), ids.alias("event_type"), F.lit("2024-01-01 01:00:00").cast("timestamp").alias("ts"))
    monkeypatch.setattr(R, "load_table", lambda *a: ev)
    monkeypatch.setattr(R, "_landed", lambda *a, landed=R._landed, **kw: roots.append(landed(*a, **kw)) or roots[-1])
    roots = []
    assert sorted(map(tuple, R.q_readings_json_arrays(spark, "").collect())) == [("click", 20_000), ("view", 5_000)]
    assert R.q_landing_records(spark, "").distinct().count() == 25_000
    for root in roots:
        files = spark.read.text(f"{root}/in", wholetext=True)
        assert max(r.n for r in files.select(F.regexp_count("value", F.lit("event_id")).alias("n")).collect()) <= 10_000
