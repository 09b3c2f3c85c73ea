"""Fixture-level checks of the reference's rules (FIXTURES F3-F9, R18)."""

import json

from pyspark.sql import functions as F

from voltframe.functions import formats as FM
from voltframe.functions import semistructured as SS
from voltframe.operators.duplicates import dedup_report, duplicate_values
from voltframe.sources.genmix import genmix_records, transform_kwh
from voltframe.sources.zones import LOAD_ZONES, ZONES, zones

IDS = [7, 3, 9, 7, 3, 12, 40, 9, 9, 5]


def test_f9_duplicates(spark):
    df = spark.createDataFrame([(i,) for i in IDS], "id long")
    assert sorted(r["value"] for r in duplicate_values(df, "id").collect()) == [3, 7, 9]
    r = dedup_report(df, "id").first()
    assert (r["total_records"], r["distinct_records"], r["duplicates_removed"]) == (10, 6, 4)


def test_f9_random_linear_equals_quadratic(spark):
    import random
    rnd = random.Random(7)
    for n in (100, 500, 1000):
        data = [rnd.randint(1, n // 2) for _ in range(n)]
        quad = sorted({a for i, a in enumerate(data) for b in data[i + 1:] if a == b})
        df = spark.createDataFrame([(x,) for x in data], "v long")
        assert sorted(r["value"] for r in duplicate_values(df, "v").collect()) == quad


def test_f3_genmix_edges(spark):
    payload = {"GenMixes": [
        {"GenMixs": [{"BeginDate": "2025-06-04T10:00:00", "GenMw": 1.5},
                     {"BeginDate": "2025-06-04T10:05:00"},           # missing GenMw -> 0
                     {"GenMw": 2},                                   # missing BeginDate -> ''
                     {"BeginDate": "2025-06-04T10:00:00", "GenMw": 1.5}]},  # repeated row
        {},                                                          # missing inner array
    ]}
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    rows = [tuple(r) for r in genmix_records(df).collect()]
    assert rows == [("2025-06-04T10:00:00", 1500.0), ("2025-06-04T10:05:00", 0.0), ("", 2000.0),
                    ("2025-06-04T10:00:00", 1500.0)]
    assert transform_kwh(genmix_records(df)).count() == 3


def test_f5_flatten_keys(spark):
    doc = {"plant": {"name": "north", "units": {"a": 2, "b": 0.5}}, "series": [{"at": "06:00", "mw": 3.25}, {"at": "07:00"}], "tags": ["x", None, True]}
    df = spark.createDataFrame([(1, json.dumps(doc))], "id long, doc string")
    got = {r["key"]: r["value"] for r in SS.flatten_json(df, ["id"], "doc").collect()}
    assert got == {"plant_name": "north", "plant_units_a": "2", "plant_units_b": "0.5", "series_0_at": "06:00", "series_0_mw": "3.25",
                   "series_1_at": "07:00", "tags_0": "x", "tags_1": None, "tags_2": "True"}


def test_flatten_edges(spark):
    docs = [(1, '[{"q": 1}, {"q": 2.0}]'),            # top-level list keeps the leading '_'
            (2, '{"a": {}, "b": [], "c": null, "d": true, "e": [[1, 2], []]}'),
            (3, '"scalar"')]
    df = spark.createDataFrame(docs, "id long, doc string")
    got = {(r["id"], r["key"]): r["value"] for r in SS.flatten_json(df, ["id"], "doc").collect()}
    assert got == {(1, "_0_q"): "1", (1, "_1_q"): "2.0", (2, "c"): None, (2, "d"): "True",
                   (2, "e_0_0"): "1", (2, "e_0_1"): "2", (3, ""): "scalar"}


def test_flatten_preserves_leaf_count(spark):
    doc = {"x": [{"y": i, "z": [i, i + 1]} for i in range(5)], "w": {"v": {"u": "deep"}}}
    df = spark.createDataFrame([(1, json.dumps(doc))], "id long, doc string")
    assert SS.flatten_json(df, ["id"], "doc").count() == 5 * 3 + 1


def test_f6_text_record_count_and_format(spark):
    text = "line one\nline two\nline three"
    df = spark.createDataFrame([(text,), ("",), ("[1, 2, 3]",), ('{"a": 1}',)], "t string")
    got = [r[0] for r in df.select(SS.record_count(F.col("t"))).collect()]
    assert got == [3, 0, 3, 1]
    fmt = df.select(FM.detect_by_content(F.col("t"))).first()[0]
    assert fmt == "txt"


def test_format_detection_rules(spark):
    rows = [("a.CSV", "x"), ("page.htm", "x"), ("noext", "<?xml version='1.0'?><a/>"),
            ("noext", "<!DOCTYPE html><html><body>x</body></html>"), ("noext", "a\tb\nc\td"),
            ("noext", "a,b\nc,d"), ("noext", "plain"), ("noext", '{"k": 1}'), ("x.unknown", "a,b\n1,2")]
    df = spark.createDataFrame(rows, "path string, content string")
    got = [r[0] for r in df.select(FM.detect_by_extension(F.col("path"), F.col("content"))).collect()]
    assert got == ["csv", "html", "xml", "xml", "tsv", "csv", "txt", "json", "csv"]
    html_first = df.select(FM.detect_by_content(F.col("content"), html_first=True)).collect()[3][0]
    assert html_first == "html"


def test_header_detection_and_declared(spark):
    rows = [("Application/JSON; charset=utf-8", "<x>"), ("text/tab-separated-values", "a"), (None, "<x>"),
            (None, "a,b\nc"), (None, None)]
    df = spark.createDataFrame(rows, "ct string, c string")
    got = [r[0] for r in df.select(FM.detect_by_header(F.col("ct"), F.col("c"))).collect()]
    assert got == ["json", "tsv", "xml", "csv", "bin"]
    d = spark.createDataFrame([("CSV", "txt"), ("weird", "txt")], "decl string, det string")
    assert [r[0] for r in d.select(FM.declared_or_detected(F.col("decl"), F.col("det"))).collect()] == ["csv", "txt"]


def test_zone_dimension(spark):
    z = zones(spark)
    assert z.count() == 9
    assert sorted(c for _, _, c in ZONES if c) == sorted(LOAD_ZONES)
    by_code = {r["location_code"]: r["zone_name"] for r in z.collect()}
    assert by_code[".Z.WCMASS"].startswith("Western/Central")
    assert by_code[".Z.NEMASSBOST"].startswith("Northeast")


def test_redaction_is_case_insensitive(spark):
    df = spark.createDataFrame([({"Authorization": "x", "COOKIE": "y", "Accept": "z"},)], "h map<string,string>")
    got = df.select(SS.redact_headers(F.col("h"))).first()[0]
    assert got == {"Authorization": "[REDACTED]", "COOKIE": "[REDACTED]", "Accept": "z"}


def test_valid_url(spark):
    urls = [("http://a.b/c",), ("HTTPS://a.b",), ("ftp://a.b",), ("http:///nohost",), ("not a url",)]
    df = spark.createDataFrame(urls, "u string")
    assert [r[0] for r in df.select(SS.valid_url(F.col("u"))).collect()] == [True, True, False, False, False]


def test_url_template_fill(spark):
    from voltframe.operators.gaps import fill_url_template
    df = spark.createDataFrame([("https://h/x/{day}?t={type}&z={day}", {"day": "20250515", "type": "a", "unused": "q"})],
                               "t string, p map<string,string>")
    assert df.select(fill_url_template(F.col("t"), F.col("p"))).first()[0] == "https://h/x/20250515?t=a&z=20250515"


def test_to_xml_record_names(spark):
    df = spark.createDataFrame([(1, "x")], "`api name` int, `file-type` string")
    xml = df.select(SS.to_xml_record(df)).first()[0]
    assert "<api_name>1</api_name>" in xml and "<file_type>x</file_type>" in xml


def test_peaks_with_hot_identical_key(spark):
    from voltframe.operators.series import local_peaks
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, 5.0)] * 3000 + [(t0 + dt.timedelta(minutes=i), float(i % 7)) for i in range(1, 500)]
    df = spark.createDataFrame(rows, "DateTime timestamp_ntz, kWh double")
    out = local_peaks(df, partitions=8)
    assert out.count() == len(rows)
    assert out.filter("DateTime = '2024-01-01 00:00:00'").filter("prev_kwh IS NULL").count() == 1


def test_flatten_strip_leading_sep(spark):
    df = spark.createDataFrame([(1, '[{"q": 1}]')], "id long, doc string")
    got = [r["key"] for r in SS.flatten_json(df, ["id"], "doc", strip_leading_sep=True).collect()]
    assert got == ["0_q"]


def test_approx_quantiles_close(spark):
    import numpy as np
    from voltframe.operators.quantiles import approx_quantiles
    vals = np.arange(10000, dtype=float)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = approx_quantiles(df, "v", [0.5, 0.95])
    assert abs(got[0] - 4999.5) <= 2 and abs(got[1] - 9499.05) <= 2


def test_quarantine_splits_rows(spark):
    from voltframe.operators.validate import quarantine
    df = spark.createDataFrame([("2025-01-01", "A", 1.0), (None, "A", 1.0), ("2025-01-01", "A", None)],
                               "timestamp string, location_id string, lmp_total double")
    good, bad = quarantine(df)
    assert (good.count(), bad.count()) == (1, 2)


def test_flatten_wide_pivot(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2}')], "id long, doc string")
    wide = SS.flatten_wide(SS.flatten_json(df, ["id"], "doc"), ["id"], ["a", "b_c"])
    got = {r["id"]: (r["a"], r["b_c"]) for r in wide.collect()}
    assert got == {1: ("1", "x"), 2: ("2", None)}


def test_anomaly_edges(spark):
    import pytest
    from voltframe.operators.anomaly import flag_anomalies
    df = spark.createDataFrame([(float(v),) for v in [5, 5, 5, 5, 9]], "lmp_total double")
    mad = [r["is_anomaly"] for r in flag_anomalies(df, method="modified_zscore").collect()]
    assert mad == [False, False, False, False, True]          # MAD 0: anything off the median
    iqr = [r["is_anomaly"] for r in flag_anomalies(df, method="iqr").collect()]
    assert iqr == [False, False, False, False, True]          # IQR 0: bounds collapse to 5
    flat = spark.createDataFrame([(3.0,), (3.0,)], "lmp_total double")
    assert [r["is_anomaly"] for r in flag_anomalies(flat, method="zscore").collect()] == [False, False]
    one = spark.createDataFrame([(3.0,)], "lmp_total double")
    assert flag_anomalies(one, method="zscore").first()["is_anomaly"] is False   # std of one row is NULL
    with pytest.raises(ValueError):
        flag_anomalies(df, method="nope")


def test_flatten_key_clash_resolution(spark):
    # 'a_b' and a -> b join to the same key: one leaf survives (the later one in key order)
    df = spark.createDataFrame([(1, '{"a": {"b": 1}, "a_b": 2}'), (2, '{"x": {"y": 3}}')], "id long, doc string")
    got = sorted((r["id"], r["key"], r["value"]) for r in SS.flatten_json(df, ["id"], "doc").collect())
    assert got == [(1, "a_b", "2"), (2, "x_y", "3")]


def test_flatten_struct_ragged_arrays(spark):
    schema = "id long, d struct<a: int, xs: array<struct<q: int, ys: array<int>>>, m: map<string,int>>"
    rows = [(1, {"a": 1, "xs": [{"q": 5, "ys": [1, 2]}, {"q": 6, "ys": []}], "m": {"k": 1}}),
            (2, {"a": 2, "xs": [], "m": None})]
    df = spark.createDataFrame(rows, schema)
    out = SS.flatten_struct(df, ["id"], "d")
    # each array path expands to its own observed maximum: xs[1].ys is always empty, so it vanishes
    assert out.columns == ["id", "a", "m", "xs_0_q", "xs_1_q", "xs_0_ys_0", "xs_0_ys_1"]
    got = {r["id"]: r.asDict() for r in out.collect()}
    assert (got[1]["xs_0_ys_1"], got[1]["xs_1_q"], got[1]["m"]) == (2, 6, '{"k":1}')
    assert got[2]["xs_0_q"] is None and got[2]["a"] == 2


def test_to_xml_payload_items(spark):
    schema = "id long, d struct<`api name`: string, readings: array<struct<`time-stamp`: string, value: double>>>"
    df = spark.createDataFrame([(1, {"api name": "x", "readings": [{"time-stamp": "t0", "value": 1.5},
                                                                   {"time-stamp": "t1", "value": 2.0}]})], schema)
    xml = df.select(SS.to_xml_payload(df, "d")).first()[0]
    compact = "".join(part.strip() for part in xml.splitlines())
    assert compact == ("<root><api_name>x</api_name><readings><item_0><time_stamp>t0</time_stamp><value>1.5</value>"
                       "</item_0><item_1><time_stamp>t1</time_stamp><value>2.0</value></item_1></readings></root>")


def test_anomaly_approx_opt_in(spark):
    from voltframe.operators.anomaly import anomaly_bounds
    df = spark.createDataFrame([(float(v),) for v in range(1, 1001)], "lmp_total double")
    exact = anomaly_bounds(df, method="iqr")
    approx = anomaly_bounds(df, method="iqr", approx=True)
    assert abs(exact["q1"] - approx["q1"]) <= 1 and abs(exact["q3"] - approx["q3"]) <= 1
    m = anomaly_bounds(df, method="modified_zscore", approx=True)
    assert abs(m["median"] - 500.5) <= 1 and abs(m["mad"] - 250) <= 1
