"""JSON arrays read by byte ranges against Python's parser."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from voltframe.session import scratch_path
from voltframe.sources import json_ranges as J

NASTY = ['}{][,"', "\\", "\\\"}", "é日本😀", "a}b{c", "", "\n", '"', "{\"x\": 1}", "}}}}", "\\\\", "[", "]"]


def files_of(seed, n):
    rng, out = random.Random(seed), []
    for i in range(n):
        rows = [{"id": f"{i}-{k}", rng.choice(NASTY) or "t": rng.choice(NASTY), "in": {"a": [{"b": rng.choice(NASTY)}, [], {}], "c": rng.random()}}
                for k in range(rng.choice([0, 1, 3, 400]))]
        value = rows[0] if rows and i % 5 == 0 else rows
        text = json.dumps(value, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        out.append((rng.choice(["", " \n", "﻿"]) + text + rng.choice(["", "\n"]), value if isinstance(value, list) else [value]))
    return out


@pytest.fixture()
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("1500", "0")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def put(spark, texts):
    root = scratch_path(spark, "json-ranges")
    os.makedirs(root)
    for i, t in enumerate(texts):
        with open(f"{root}/{i}.json", "w", encoding="utf-8", newline="") as f:
            f.write(t)
    return root


def texts_of(df):
    return sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in df.collect())


def test_records_of_any_text_in_many_ranges(spark, small_ranges):
    made = files_of(1, 12)
    root = put(spark, [t for t, _ in made])
    ranges = J._ranges(spark, root)
    assert ranges.select("path", "begin").distinct().count() > 40 and ranges.rdd.getNumPartitions() > 20
    got = J.json_array_texts(spark, root)
    assert texts_of(got) == sorted(json.dumps(r, sort_keys=True) for _, rows in made for r in rows)
    assert J.broken_files(spark, root) == []


def test_a_record_longer_than_its_ranges(spark, small_ranges):
    long = {"id": "long", "items": [{"n": i, "t": "}{"} for i in range(2000)]}
    root = put(spark, [json.dumps([{"id": "before"}, long, {"id": "after"}]), json.dumps(long)])
    assert texts_of(J.json_array_texts(spark, root)) == sorted(json.dumps(r, sort_keys=True) for r in ({"id": "before"}, long, {"id": "after"}, long))


@pytest.mark.parametrize("cut", [7, 30, 3000, 9000])
def test_a_file_that_ends_inside_a_record(spark, small_ranges, cut):
    rows = [{"id": i, "text": "a } b"} for i in range(500)]
    text = json.dumps(rows)
    root = put(spark, [text[:cut], text])
    got = [json.loads(r["text"]) for r in J.json_array_texts(spark, root).where(F.col("path").endswith("0.json")).collect()]
    assert all(r in rows for r in got) and len(got) == text[:cut].count('"}') and [p[-6:] for p in J.broken_files(spark, root)] == ["0.json"]


def test_typed_records_and_an_empty_folder(spark):
    from voltframe.schemas import READING_TEXT
    root = put(spark, ['[{"timestamp": "2025-01-01T00:00:00", "location_id": "A", "lmp_total": 1.5}, {"location_id": "B"}]', "[]", ""])
    rows = J.read_json_arrays(spark, root, READING_TEXT).collect()
    assert sorted((r["location_id"], r["lmp_total"]) for r in rows) == [("A", "1.5"), ("B", None)]
