"""Opt-in scale smoke test (VOLTFRAME_SCALE=1): ten time-shifted copies of the sf0.1
events (1M readings, derived from the given table) through the main plans; results
must stay consistent with the single copy."""

import os
from functools import reduce

import pytest
from pyspark.sql import functions as F

from voltframe.operators.gaps import missing_intervals
from voltframe.plans import kwh as KW
from voltframe.plans.enrich import enrich_readings
from voltframe.sources.adapters import kwh_from_events, readings_from_events
from voltframe.sources.tables import load_table

pytestmark = pytest.mark.skipif(not os.environ.get("VOLTFRAME_SCALE"), reason="set VOLTFRAME_SCALE=1")
COPIES = 10


def _copies(spark):
    ev = load_table(spark, "/root/testdata/sf0.1", "events")
    return ev, reduce(lambda a, b: a.unionByName(b), [
        ev.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {31 * k} DAYS"))
          .withColumn("event_id", F.col("event_id") + k * 10_000_000) for k in range(COPIES)])


def test_scaled_plans_stay_consistent(spark):
    one, many = _copies(spark)
    order = ["extraction_time", "event_id"]
    n_one = enrich_readings(readings_from_events(one), order=order).readings.count()
    n_many = enrich_readings(readings_from_events(many), order=order).readings.count()
    assert n_many == COPIES * n_one                       # copies never collide (31-day shifts)
    months = KW.monthly_trend(kwh_from_events(many), "2024-12-31", exact=True).collect()
    assert sum(r["reading_count"] for r in months) > 0
    assert missing_intervals(readings_from_events(many)).count() >= COPIES * missing_intervals(
        readings_from_events(one)).count()
