"""Unknown JSON payloads as XML and as text, against Python's own libraries."""

import datetime as dt
import json
import random
import xml.etree.ElementTree as ET
from decimal import Decimal

from pyspark.sql import functions as F

from voltframe.functions import semistructured as SS

NAMES = ["a", "b c", "d-e", "1st", "x&y", "é", "", "item_0", "_"]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 6)
    if kind == 6:
        return {rng.choice(NAMES): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    if kind == 7:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return [None, True, rng.randint(-5, 10**20), rng.random(), "t<&>\"'" + rng.choice(["", "\n x", "é\x01"]), ""][kind]


def shape(v):
    """What the elements should hold: (children by name in order) or text."""
    if isinstance(v, dict):
        return [(SS._element(k), shape(x)) for k, x in v.items()] or ""
    if isinstance(v, list):
        return [(f"item_{i}", shape(x)) for i, x in enumerate(v)] or ""
    return str(v).replace("\x01", "\ufffd")


def read(e):
    return [(c.tag, read(c)) for c in e] or (e.text or "")


def test_any_json_becomes_xml_that_reads_back(spark):
    rng = random.Random(4)
    values = [value(rng) for _ in range(300)] + [{"a": {"b": [[], {}, [1, [2]]]}}, "text", None]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(1000, "{no json"), (1001, None)]
    got = {r["id"]: r["xml"] for r in SS.json_to_xml(spark.createDataFrame(rows, "id long, doc string"), ["id"], "doc").collect()}
    assert set(got) == set(range(len(values)))
    for i, v in enumerate(values):
        root = ET.fromstring(got[i])
        assert root.tag == "root" and read(root) == shape(v)
    deep = "[" * 5000 + "]" * 5000
    assert SS.json_to_xml(spark.createDataFrame([(1, deep)], "id long, doc string"), ["id"], "doc").count() <= 1


def flat(rows, sep="_"):
    return sorted((i, k, v) for i, t in rows if t is not None for k, v in dict(SS._leaves(json.loads(t), sep)).items())


def long_rows(spark, rows, **kw):
    df = SS.flatten_json(spark.createDataFrame(rows, "id long, doc string"), ["id"], "doc", native=True, **kw)
    return df, sorted(((r["id"], r["key"], r["value"]) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def regular(rng):
    """Documents of one shape in which anything may be missing, null or empty."""
    def some(v):
        return rng.choice([v, v, v, None])
    doc = {"id": some(rng.randint(-9, 10**15)), "x y": some(rng.choice([1, 2.5, 1e-7, 123456.0, 1e20, -3])), "t": some(rng.choice(["", "é<", "2024-01-02", "true"])),
           "ok": some(rng.random() < 0.5), "in": some({"a_b": some("z"), "e": {}, "n": None, "deep": {"l": [some(1), some(2.0)]}}),
           "rows": some([{"k": some(i), "m": [[some(i)], []]} for i in range(rng.randint(0, 12))])}
    return {k: v for k, v in doc.items() if rng.random() < 0.8}


def test_regular_documents_are_flattened_in_the_jvm(spark):
    rng = random.Random(7)
    rows = [(i, json.dumps(regular(rng), ensure_ascii=rng.random() < 0.5)) for i in range(300)] + [(900, None), (901, "{}"), (902, "null")]
    df, got = long_rows(spark, rows)
    assert got == sorted(flat(rows), key=str) and "MapInArrow" not in plan(df) and "Exchange" not in plan(df)
    listed = [(i, json.dumps([json.loads(t or "null"), 5])) for i, t in rows]
    assert long_rows(spark, [(i, t.replace(", 5]", "]")) for i, t in listed])[1] == sorted(flat([(i, t.replace(", 5]", "]")) for i, t in listed]), key=str)


def test_documents_that_variant_cannot_stand_for_go_to_the_parser(spark):
    odd = ['{"id": 123456789012345678901234567890}', '{"id": -0.0}', '{"id": 1e400}', '{"id": NaN}', '{"id": 1.5e-310}']
    rows = [(i, json.dumps({"id": i, "v": i / 3})) for i in range(20)] + [(100 + i, t) for i, t in enumerate(odd)] + [(200, "{broken"), (201, '{"id": 1, "id": 2}')]
    df, got = long_rows(spark, rows)
    assert got == sorted(flat([r for r in rows if r[0] != 200]), key=str) and "MapInArrow" in plan(df)


def test_open_shapes_and_clashing_keys_go_to_the_parser(spark):
    for docs in (['{"a": 1}', '{"a": {"b": 2}}'], ['{"a": [5], "a_0": "later"}', '{"a_0": "first", "a": [6]}'], ['{"a": {"b": 1}, "a_b": 2}'],
                 ['{"a": {"0": 1}}', '{"a": {"0": 2}, "it\'s": 3}'], ['{"": 1}', '{"x": {"": 2}}']):
        rows = list(enumerate(docs))
        assert long_rows(spark, rows)[1] == sorted(flat(rows), key=str)


def test_any_json_flattens_as_the_parser_says(spark):
    rng = random.Random(11)
    for seed in range(3):
        rows = [(i, json.dumps(value(rng))) for i in range(60)]
        assert long_rows(spark, rows)[1] == sorted(flat(rows), key=str)
        assert long_rows(spark, rows, sep=".")[1] == sorted(flat(rows, "."), key=str)


def records(rows):
    out = []
    for i, t in rows:
        v = json.loads(t)
        for n, r in enumerate(v if isinstance(v, list) else [v]):
            found = dict(SS._leaves(r, "_")).items() if isinstance(r, (dict, list)) else [("value", None if r is None else str(r))]
            out += [(i, n, k, x) for k, x in found]
    return sorted(out, key=str)


def test_payload_records_of_lists_objects_and_scalars(spark):
    rng = random.Random(9)
    docs = []
    for _ in range(120):
        kind = rng.randrange(4)
        docs.append([regular(rng) for _ in range(rng.randint(0, 3))] + [None] * rng.randint(0, 1) if kind == 0 else regular(rng) if kind == 1
                    else rng.choice([1, 2.5, "t", "", None, True]) if kind == 2 else {"other": [[1], []]})
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    df = SS.payload_rows(spark.createDataFrame(rows, "id long, doc string"), ["id"], "doc", native=True)
    assert sorted(map(tuple, df.collect()), key=str) == records(rows) and "MapInArrow" not in plan(df)
    for texts in (["[1, [2], {\"a\": 3}]", "[[1, 2], [3]]"], ["[[1, 2], [3]]", "[]"], ["[1, 2.0, null]", "7"], ["{\"a\": 1}", "{\"a\": [2]}", "[]", "-0.0"]):
        rows = list(enumerate(texts))
        got = SS.payload_rows(spark.createDataFrame(rows, "id long, doc string"), ["id"], "doc", native=True)
        assert sorted(map(tuple, got.collect()), key=str) == records(rows)


def test_wide_frames(spark):
    rng = random.Random(8)
    rows = [(i, json.dumps(regular(rng))) for i in range(80)]
    frame = spark.createDataFrame(rows, "id long, doc string").withColumnRenamed("id", "n")
    wide = SS.flatten_json_wide(frame, ["n"], "doc")
    want = {}
    for i, k, v in flat(rows):
        want.setdefault(i, {})[k] = v
    for r in wide.collect():
        assert {k: v for k, v in r.asDict().items() if v is not None and k != "n"} == {k: v for k, v in want.get(r["n"], {}).items() if v is not None}
    assert "MapInArrow" not in plan(wide) and "Exchange" not in plan(wide)
    mixed = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": {"b": 2}}')], "n long, doc string")
    assert {r["n"]: (r["a"], r["a_b"]) for r in SS.flatten_json_wide(mixed, ["n"], "doc").collect()} == {1: ("1", None), 2: (None, "2")}


def test_names_follow_the_rule():
    assert [SS._element(n) for n in NAMES] == ["a", "b_c", "d_e", "_1st", "x_y", "é", "_", "item_0", "_"]


def test_json_text_writes_values_as_python_does(spark):
    rows = [(1, dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), Decimal("1.50"), None, [dt.datetime(2024, 1, 1, 0, 0, 0, 7)], (None, dt.date(2020, 2, 29))),
            (2, dt.datetime(2024, 1, 2, 3, 4, 5, 120), None, None, "é\"", None, None)]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz, day date, amount decimal(9,2), text string, times array<timestamp_ntz>, more struct<a: string, d: date>")
    got = [r["t"] for r in df.select(SS.json_text(df).alias("t"), F.col("id")).orderBy("id").collect()]
    names = df.columns
    plain = [{**dict(zip(names, r)), "more": None if r[6] is None else {"a": r[6][0], "d": r[6][1]}} for r in rows]
    assert [json.loads(g) for g in got] == [json.loads(json.dumps(p, default=str)) for p in plain]
    assert [list(json.loads(g)) for g in got] == [names, names]
