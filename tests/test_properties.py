"""Brute-force checks on random inputs, one Spark job per property."""

import json
import random

from pyspark.sql import functions as F

from voltframe.functions import formats as FM
from voltframe.functions import semistructured as SS

FLOATS = [1.5, 0.1, 1e-07, 1e20, 123456789.0, -2.25, 141.0, 0.0001, 3e-05, 6.55, 12345.678, 1000.0, 2.675,
          0.30000000000000004, 1234567890123456.0, 9999999999999998.0, 1e16, 0.00012345, -0.001, 1.7976931348623157e308]


def _doc(rng, depth=0):
    kind = rng.random()
    if depth >= 4 or kind < 0.35:
        leaf = rng.choice(["int", "str", "bool", "null", "float"])
        return {"int": rng.randint(-50, 50), "str": rng.choice(["a", "b c", "é", ""]), "bool": rng.random() < 0.5,
                "null": None, "float": rng.choice(FLOATS)}[leaf]
    if kind < 0.7:
        keys = rng.sample("abcdefgh", rng.randint(0, 4))   # letters only: no key clashes
        return {k: _doc(rng, depth + 1) for k in keys}
    return [_doc(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def _text(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _flatten(v, key=""):
    """The documented rule in plain Python."""
    out = {}
    if isinstance(v, dict):
        for k, child in v.items():
            out.update(_flatten(child, f"{key}_{k}" if key else k))
    elif isinstance(v, list):
        for i, child in enumerate(v):
            out.update(_flatten(child, f"{key}_{i}"))
    else:
        out[key] = _text(v)
    return out


def test_flatten_matches_brute_force(spark):
    rng = random.Random(2024)
    docs = [(i, json.dumps(_doc(rng))) for i in range(300)]
    df = spark.createDataFrame(docs, "id long, doc string")
    got = {}
    for r in SS.flatten_json(df, ["id"], "doc").collect():
        got.setdefault(r["id"], {})[r["key"]] = r["value"]
    for i, text in docs:
        assert got.get(i, {}) == _flatten(json.loads(text)), text


def test_flatten_one_document_at_a_time(spark):
    rng = random.Random(31)
    docs = ['{"a":[1,[2,3]]}', '{"r":[{"x":1},{"x":{"y":2}}]}', '{"a":1,"a":2}', '{"":{"x":1}}', "[[],{}]", "7", '"t"', "null",
            '{"a_0":5,"a":[6]}'] + [json.dumps(_doc(rng)) for _ in range(12)]
    for text in docs:
        df = spark.createDataFrame([(1, text)], "id long, doc string")
        got = {r["key"]: r["value"] for r in SS.flatten_json(df, ["id"], "doc").collect()}
        assert got == _flatten(json.loads(text)), text


def test_flatten_has_no_size_or_depth_limit_of_its_own(spark):
    deep = "[" * 500 + "1" + "]" * 500
    long = json.dumps({"a": ["x" * 1000] * 18_000})
    df = spark.createDataFrame([(1, deep), (2, long), (3, "{"), (4, None), (5, "[" * 200_000)], "id long, doc string")
    counts = {r["id"]: r["count"] for r in SS.flatten_json(df, ["id"], "doc").groupBy("id").count().collect()}
    assert counts == {1: 1, 2: 18_000}
    rejects = {r["id"]: r["n_chars"] for r in SS.payload_rejects(df, ["id"], "doc").collect()}
    assert rejects == {3: 1, 5: 200_000}
    got = {r["id"]: (r["f"], r["n"]) for r in df.select("id", FM.detect_by_content(F.col("doc")).alias("f"), SS.record_count(F.col("doc")).alias("n")).collect()}
    assert got[2] == ("json", 1) and got[3] == ("txt", 1) and got[4] == ("bin", 0)


def _detect(path, data):
    """SF2 rules in plain Python."""
    ext = path.lower().split(".")[-1] if "." in path else ""
    table = {"csv": "csv", "json": "json", "txt": "txt", "xml": "xml", "tsv": "tsv", "html": "html",
             "htm": "html", "yaml": "yaml", "yml": "yaml", "parquet": "parquet", "bin": "bin"}
    if ext in table:
        return table[ext]
    try:
        if isinstance(json.loads(data), (dict, list)):
            return "json"
    except ValueError:
        pass
    low = data.strip(" \t\n\r\x0b\x0c").lower()
    if low.startswith("<?xml") or (low.startswith("<") and low.endswith(">")):
        return "xml"
    if low.startswith("<!doctype html") or "<html" in low:
        return "html"
    if "\t" in data and "\n" in data:
        return "tsv"
    if "," in data and "\n" in data:
        return "csv"
    return "txt"


def test_format_detection_matches_brute_force(spark):
    rng = random.Random(7)
    parts = ["<", ">", "<?xml", "<HTML", "<!DOCTYPE html", ",", "\n", "\t", " ", "x", "{", "}", "[1]", '"k"', ":"]
    names = ["a.csv", "b.JSON", "c", "d.htm", "e.x.yml", "f.unknown", "g"]
    rows = [(rng.choice(names), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "p string, c string")
    got = [r[0] for r in df.select(FM.detect_by_extension(F.col("p"), F.col("c"))).collect()]
    assert got == [_detect(p, c) for p, c in rows]


def test_record_count_matches_brute_force(spark):
    rng = random.Random(5)
    samples = ["", "a", "a\nb", "\n", "[1, 2, 3]", "[]", '{"a": 1}', "{bad", "[1, [2]]", "x\ny\nz\n"]
    rows = [(rng.choice(samples),) for _ in range(200)]

    def brute(t):
        try:
            v = json.loads(t)
            if isinstance(v, list):
                return len(v)
            if isinstance(v, dict):
                return 1
        except ValueError:
            pass
        return t.count("\n") + 1 if t else 0
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(SS.record_count(F.col("t"))).collect()]
    assert got == [brute(t) for (t,) in rows]


def test_dedup_first_matches_pandas(spark):
    import datetime as dt
    import pandas as pd
    from voltframe.operators.clean import dedup_first
    rng = random.Random(13)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        ext = None if rng.random() < 0.2 else t0 + dt.timedelta(minutes=rng.randint(0, 5))
        rows.append((t0 + dt.timedelta(minutes=15 * rng.randint(0, 20)), rng.choice("ABC"), ext, i, float(i)))
    schema = "timestamp timestamp_ntz, location_id string, extraction_time timestamp_ntz, event_id long, v double"
    got = dedup_first(spark.createDataFrame(rows, schema), ["timestamp", "location_id"],
                      ["extraction_time", "event_id"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "location_id", "extraction_time", "event_id", "v"])
    want = (pdf.sort_values(["extraction_time", "event_id"], na_position="last")
            .drop_duplicates(["timestamp", "location_id"], keep="first"))
    assert sorted(got["event_id"]) == sorted(want["event_id"])


def test_trim_first_option(spark):
    from voltframe.operators.clean import clean_readings
    from voltframe.schemas import READING_TEXT
    rows = [("2025-01-01T00:00:00Z", " A", None, "1", "1", "1", "1", "2025-01-01T00:01:00Z"),
            ("2025-01-01T00:00:00Z", "A", None, "2", "1", "1", "1", "2025-01-01T00:02:00Z")]
    df = spark.createDataFrame(rows, READING_TEXT)
    assert clean_readings(df).count() == 2                    # reference order: dedup before trim
    assert clean_readings(df, trim_first=True).count() == 1   # option: trim, then dedup


def test_round_to_matches_duckdb(spark):
    import duckdb
    from voltframe.functions.numeric import round_to
    rng = random.Random(21)
    vals = [rng.uniform(-1000, 1000) for _ in range(300)] + [k / 8 for k in range(-40, 40)]   # includes exact ties
    vals += [2.675, 1.005, 0.125, -0.125, 45.85, 0.4950, 3.89425, 1e-10, 123456.78905]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (1, 2, 4):
        got = [r[0] for r in df.select(round_to(F.col("x"), d)).collect()]
        want = [r[0] for r in duckdb.sql(f"SELECT round(round(x, 9), {d}) FROM (SELECT unnest(?) AS x)",
                                         params=[vals]).fetchall()]
        assert got == want, d


def test_time_fields_match_python_calendar(spark):
    import datetime as dt
    from voltframe.functions.timefields import add_time_fields
    rng = random.Random(3)
    stamps = [dt.datetime(2019, 1, 1) + dt.timedelta(minutes=15 * rng.randint(0, 4 * 24 * 365 * 6)) for _ in range(500)]
    stamps += [dt.datetime(2020, 12, 31, 23, 45), dt.datetime(2021, 1, 3, 7, 0), dt.datetime(2024, 2, 29, 22, 59)]
    df = spark.createDataFrame([(t,) for t in stamps], "timestamp timestamp_ntz")
    seasons = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
               6: "Summer", 7: "Summer", 8: "Summer", 9: "Fall", 10: "Fall", 11: "Fall"}
    for r in add_time_fields(df).collect():
        t = r["timestamp"]
        weekend, peak = t.weekday() in (5, 6), 7 <= t.hour <= 22
        assert (r["date"], r["hour_of_day"], r["minute_of_hour"]) == (t.strftime("%Y-%m-%d"), t.hour, t.minute)
        assert (r["day_of_week"], r["day_of_year"], r["week_of_year"]) == (t.weekday(), t.timetuple().tm_yday,
                                                                           t.isocalendar()[1])
        assert (r["month"], r["quarter"], r["year"]) == (t.month, (t.month - 1) // 3 + 1, t.year)
        assert r["hour"] == t.replace(minute=0, second=0, microsecond=0)
        assert (r["is_weekend"], r["is_peak_hour"], r["is_business_hour"]) == (weekend, peak, 9 <= t.hour <= 17)
        assert r["season"] == seasons[t.month]
        assert r["time_period"] == ("Weekend" if weekend else "Peak" if peak else "Off-Peak")


def test_numeric_rules_match_python(spark):
    import math
    from voltframe.functions.numeric import congestion_level, loss_percentage, pct_diff
    rng = random.Random(8)
    rows = [(rng.choice([0.0, 5.0, 15.0, -3.0, rng.uniform(-20, 40)]), rng.choice([0.0, rng.uniform(-50, 500)]),
             rng.choice([0.0, rng.uniform(-5, 20)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "cong double, lmp double, loss double")
    out = df.select(congestion_level(F.col("cong")).alias("lvl"), loss_percentage(F.col("loss"), F.col("lmp")).alias("lp"),
                    pct_diff(F.col("lmp"), F.lit(40.0)).alias("pd")).collect()

    def level(c):
        return "None" if c <= 0 else "Low" if c <= 5 else "Medium" if c <= 15 else "High"

    def loss_pct_at_zero_price(loss):
        return 100.0 if loss > 0 else 0.0 if loss < 0 else None   # +inf, -inf, NaN through the clip

    for (cong, lmp, loss), r in zip(rows, out):
        assert r["lvl"] == level(cong)
        if lmp == 0:
            assert r["lp"] == loss_pct_at_zero_price(loss)
        else:
            raw = loss / lmp * 100
            assert r["lp"] is not None and 0.0 <= r["lp"] <= 100.0 and abs(r["lp"] - min(max(raw, 0), 100)) <= 0.005 + 1e-9
        assert math.isclose(r["pd"], (lmp - 40.0) / 40.0 * 100, abs_tol=0.005 + 1e-9)


def test_header_detection_matches_brute_force(spark):
    rng = random.Random(17)
    types = [None, "", "Application/JSON", "text/csv; charset=utf-8", "TEXT/XML", "application/xml", "text/html",
             "text/tab-separated-values", "application/octet-stream"]
    parts = ["<", ">", ",", "\n", " ", "x", "{", "}", "[1]", '"k"', ":"]
    rows = [(rng.choice(types), None if rng.random() < 0.05 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 6))))
            for _ in range(400)]

    def brute(ct, data):
        c = (ct or "").lower()
        for needles, fmt in ((("application/json",), "json"), (("text/csv",), "csv"),
                             (("text/xml", "application/xml"), "xml"), (("text/html",), "html"),
                             (("text/tab-separated-values",), "tsv")):
            if any(n in c for n in needles):
                return fmt
        if data is None:
            return "bin"
        try:
            if isinstance(json.loads(data), (dict, list)):
                return "json"
        except ValueError:
            pass
        s = data.strip(" \t\n\r\x0b\x0c")
        if s.startswith("<") and s.endswith(">"):
            return "xml"
        if "," in data and "\n" in data:
            return "csv"
        return "txt"
    df = spark.createDataFrame(rows, "ct string, c string")
    got = [r[0] for r in df.select(FM.detect_by_header(F.col("ct"), F.col("c"))).collect()]
    assert got == [brute(ct, c) for ct, c in rows]
