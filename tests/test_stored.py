"""Sketches, values across sources and runs of missing intervals against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from voltframe.operators import sketches as SK
from voltframe.operators.duplicates import across_sources, across_sources_report
from voltframe.operators.gaps import missing_days, missing_runs


def test_quantiles_merged_from_days_have_bounded_rank(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice("AB"), start + dt.timedelta(minutes=rng.randrange(40 * 1440)), rng.paretovariate(1.2)) for _ in range(20000)]
    rows += [("A", None, 5.0), ("A", start, None), ("A", start, float("nan"))]
    df = spark.createDataFrame(rows, "zone string, ts timestamp_ntz, v double")
    days = SK.daily_quantile_sketches(df, "v", "ts", ["zone"], k=200)
    got = SK.merged_quantiles(days, ["zone"], {"p10": 0.1, "p99": 0.99}).collect()
    for r in got:
        values = sorted(v for z, _, v in rows if z == r["zone"] and v is not None and v == v)
        assert r["n"] == len(values)
        for name, p in (("p10", 0.1), ("p99", 0.99)):
            below, upto = sum(v < r[name] for v in values) / len(values), sum(v <= r[name] for v in values) / len(values)
            assert below - 3 * SK.rank_error(200) <= p <= upto + 3 * SK.rank_error(200)
    checked = SK.rank_bounds(df, SK.merged_quantiles(days, ["zone"], {"p10": 0.1}), ["zone"], "v", {"p10": 0.1}, 3 * SK.rank_error(200))
    assert [r["within"] for r in checked.collect()] == [True, True]
    off = SK.merged_quantiles(days, ["zone"], {"p10": 0.4})
    assert [r["within"] for r in SK.rank_bounds(df, off, ["zone"], "v", {"p10": 0.1}, 0.05).collect()] == [False, False]


def test_windows_of_days_hold_their_days_only(spark):
    rows = [(dt.datetime(2024, 1, d), float(d)) for d in (1, 2, 3, 9, 10)]
    days = SK.daily_quantile_sketches(spark.createDataFrame(rows, "ts timestamp_ntz, v double"), "v", "ts")
    got = SK.merged_quantiles(SK.trailing_windows(days, 3), ["day"], {"low": 0.0, "high": 1.0}).collect()
    assert sorted((r["day"].day, r["n"], r["low"], r["high"]) for r in got) == [
        (1, 1, 1.0, 1.0), (2, 2, 1.0, 2.0), (3, 3, 1.0, 3.0), (9, 1, 9.0, 9.0), (10, 2, 9.0, 10.0)]
    assert SK.merged_quantiles(days.where("false"), ["day"], {"low": 0.0}).count() == 0


def test_distinct_sketches_of_sources(spark):
    sources = {"a": spark.range(0, 5000).toDF("x"), "b": spark.range(2500, 10000).toDF("y"), "none": spark.range(0).toDF("z")}
    got = {(r["first"], r["second"]): (r["distinct"], r["overlap"]) for r in SK.distinct_estimates(SK.distinct_sketches(sources)).collect()}
    assert set(got) == {("a", "a"), ("b", "b"), ("none", "none"), ("a", "b"), ("a", "none"), ("b", "none")}
    for key, (distinct, overlap) in {("a", "a"): (5000, 5000), ("b", "b"): (7500, 7500), ("a", "b"): (10000, 2500), ("a", "none"): (5000, 0)}.items():
        room = 5 * SK.distinct_error() * max(distinct, 1)
        assert abs(got[key][0] - distinct) <= room and abs(got[key][1] - overlap) <= 3 * room


def test_values_of_sources_of_several_types(spark):
    sources = {"crm": spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long"), "mail": spark.createDataFrame([("2",), ("x",)], "id string")}
    found = across_sources(sources)
    assert sorted((r["value"], r["occurrences"], r["sources"]) for r in found.collect()) == [("1", 2, ["crm"]), ("2", 2, ["crm", "mail"]), ("x", 1, ["mail"])]
    assert tuple(across_sources_report(found).first()) == (5, 3, 2, 1)


def test_runs_join_over_midnight_and_whole_days(spark):
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(6)
    slots = [start + dt.timedelta(minutes=15 * i) for i in range(96 * 6)]
    present = {"A": {slots[0], slots[95], slots[96 * 5 + 95]}, "B": set(rng.sample(slots, 300)) | {slots[0], slots[-1]}, "C": set(slots)}
    df = spark.createDataFrame([(z, t) for z, ts in present.items() for t in ts], "location_id string, timestamp timestamp_ntz")
    want = []
    for z, ts in present.items():
        run = []
        for t in [*slots, None]:
            if t is not None and t not in ts:
                run.append(t)
            elif run:
                want.append((z, run[0], run[-1], len(run)))
                run = []
    got = missing_runs(missing_days(df))
    assert sorted(tuple(r) for r in got.select("location_id", "first", "last", "intervals").collect()) == sorted(want)
    assert missing_runs(missing_days(df.where(F.lit(False)))).count() == 0
