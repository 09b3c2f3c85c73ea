"""Hand-computed golden values for the two-row LMP sample (FIXTURES F1)."""

import datetime as dt

from voltframe.plans.enrich import enrich_readings
from voltframe.schemas import READING_TEXT

SAMPLE = [
    ("2025-06-04T10:00:00Z", ".Z.MAINE", "Maine", "45.5", "40.0", "3.5", "2.0", "2025-06-04T10:05:00Z"),
    ("2025-06-04T10:15:00Z", ".Z.MAINE", "Maine", "46.2", "40.5", "3.7", "2.0", "2025-06-04T10:20:00Z"),
]


def test_golden_two_rows(spark):
    raw = spark.createDataFrame(SAMPLE, READING_TEXT)
    rows = sorted(enrich_readings(raw).readings.collect(), key=lambda r: r["minute_of_hour"])
    assert len(rows) == 2
    for r in rows:
        assert r["date"] == "2025-06-04"
        assert (r["hour_of_day"], r["day_of_week"], r["day_of_year"], r["week_of_year"]) == (10, 2, 155, 23)
        assert (r["month"], r["quarter"], r["year"], r["season"]) == (6, 2, 2025, "Summer")
        assert (r["is_weekend"], r["is_peak_hour"], r["is_business_hour"]) == (False, True, True)
        assert r["time_period"] == "Peak"
        assert r["hour"].replace(tzinfo=None) == dt.datetime(2025, 6, 4, 10, 0)
        assert (r["lmp_total_mean_hourly"], r["lmp_total_min_hourly"], r["lmp_total_max_hourly"]) == (45.85, 45.5, 46.2)
        assert r["lmp_total_std_hourly"] == 0.495 and r["lmp_total_count_hourly"] == 2
        assert (r["energy_component_mean_hourly"], r["energy_component_std_hourly"]) == (40.25, 0.3536)
        assert (r["congestion_component_mean_hourly"], r["congestion_component_std_hourly"]) == (3.6, 0.1414)
        assert (r["loss_component_mean_hourly"], r["loss_component_std_hourly"]) == (2.0, 0.0)
        assert r["lmp_volatility_hourly"] == 0.495 and r["is_high_volatility"] is False
        assert r["has_congestion"] is True and r["congestion_level"] == "Low"
        assert r["price_vs_system_avg"] == 0.0
        assert r["data_completeness_hourly"] == 50.0 and r["is_complete_hour"] is False
        assert r["location_name"] == "Maine"
    assert [r["minute_of_hour"] for r in rows] == [0, 15]
    assert [r["loss_percentage"] for r in rows] == [4.4, 4.33]
    assert [r["price_vs_daily_avg"] for r in rows] == [-0.76, 0.76]


def test_null_critical_value_rejects_whole_batch(spark):
    bad = SAMPLE + [("2025-06-04T10:30:00Z", ".Z.MAINE", "Maine", None, "1", "1", "1", None)]
    e = enrich_readings(spark.createDataFrame(bad, READING_TEXT))
    assert e.readings.count() == 0
    v = e.verdict.first()
    assert v["is_valid"] is False and v["null_lmp_total"] == 1


def test_edge_rows(spark):
    """lmp = 0, congestion exactly on the bin edges, five readings in one hour, a
    duplicate key (first by extraction time wins), bad numeric text."""
    rows = [
        ("2025-01-04T00:00:00Z", "A", None, "0", "1", "0", "1", "2025-01-04T00:01:00Z"),
        ("2025-01-04T00:15:00Z", "A", None, "10", "1", "5", "-1", "2025-01-04T00:16:00Z"),
        ("2025-01-04T00:30:00Z", "A", None, "10", "1", "15", "0", "2025-01-04T00:31:00Z"),
        ("2025-01-04T00:45:00Z", "A", None, "10", "1", "15.5", "0", "2025-01-04T00:46:00Z"),
        ("2025-01-04T00:50:00Z", "A", None, "oops", "1", "0.5", "0", "2025-01-04T00:51:00Z"),
        ("2025-01-04T00:45:00Z", "A", None, "99", "1", "1", "0", "2025-01-04T00:47:00Z"),
    ]
    out = enrich_readings(spark.createDataFrame(rows, READING_TEXT), validate=False).readings
    got = {r["minute_of_hour"]: r for r in out.collect()}
    assert len(got) == 5
    assert got[0]["loss_percentage"] == 100.0          # loss > 0 over lmp 0
    assert got[0]["congestion_level"] == "None"        # 0 is in (-inf, 0]
    assert got[15]["congestion_level"] == "Low"        # 5 is in (0, 5]
    assert got[30]["congestion_level"] == "Medium"     # 15 is in (5, 15]
    assert got[45]["congestion_level"] == "High" and got[45]["lmp_total"] == 10.0
    assert got[50]["lmp_total"] == 0.0                 # coerced then filled
    assert got[0]["data_completeness_hourly"] == 125.0 and got[0]["is_complete_hour"] is False
    assert got[0]["day_of_week"] == 5 and got[0]["time_period"] == "Weekend"


def test_empty_batch(spark):
    from voltframe.operators.summaries import batch_metadata, processing_summary
    e = enrich_readings(spark.createDataFrame([], READING_TEXT))
    assert e.readings.count() == 0
    v = e.verdict.first()
    assert v["is_empty"] is True and v["is_valid"] is True
    s = processing_summary(e.readings).first()
    assert s["status"] == "empty_dataframe" and s["record_count"] == 0
    assert batch_metadata(e.readings).first()["record_count"] == 0


def test_dst_day_and_five_readings_in_an_hour(spark):
    # 2025-03-09 is a DST switch in North America; readings are UTC, so nothing shifts
    rows = [(f"2025-03-09T07:{m:02d}:00Z", "A", None, str(10 + m), "1", "1", "1", f"2025-03-09T07:{m:02d}:30Z")
            for m in (0, 10, 15, 30, 45)]
    out = enrich_readings(spark.createDataFrame(rows, READING_TEXT)).readings.collect()
    assert len(out) == 5 and {r["hour_of_day"] for r in out} == {7}
    assert {r["data_completeness_hourly"] for r in out} == {125.0}    # may exceed 100
    assert all(r["day_of_week"] == 6 and r["time_period"] == "Weekend" for r in out)


def test_processing_summary_nested(spark):
    from voltframe.operators.summaries import processing_summary
    e = enrich_readings(spark.createDataFrame(SAMPLE, READING_TEXT)).readings
    s = processing_summary(e, nested=True).first()
    assert s["status"] == "success" and s["avg_lmp_by_zone"] == {".Z.MAINE": 45.85}
    assert s["data_completeness"]["avg"] == 50.0 and s["congestion_summary"]["intervals_with_congestion"] == 2
