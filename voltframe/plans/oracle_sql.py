"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each entry runs on the driver's pre-registered views and must produce the same column
names as the Spark query.  Shared CTE fragments are built here once.
"""

from __future__ import annotations

from voltframe.sources.adapters import KWH_SQL, READINGS_SQL

def rnd(expr: str, digits: int) -> str:
    """Rounding policy shared with ``voltframe.functions.numeric.round_to``."""
    return f"round(round({expr}, 9), {digits})"


PRICES = ["lmp_total", "energy_component", "congestion_component", "loss_component"]

R = f"r AS ({READINGS_SQL})"

# keep-first dedup on (timestamp, location_id), tie order extraction_time then event_id
D = ("d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, location_id "
     "ORDER BY extraction_time NULLS LAST, event_id) AS rn FROM r) WHERE rn = 1)")

# cleaned: trim, location_name NULL (absent in the adapter), numerics already double
C = ("c AS (SELECT timestamp, trim(location_id) AS location_id, lmp_total, energy_component, "
     "congestion_component, loss_component, extraction_time, load, event_id, "
     "CAST(NULL AS VARCHAR) AS location_name FROM d)")

TIME_COLS = """strftime(timestamp, '%Y-%m-%d') AS date,
  CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
  CAST(minute(timestamp) AS INTEGER) AS minute_of_hour,
  CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(timestamp) AS INTEGER) AS day_of_year,
  CAST(week(timestamp) AS INTEGER) AS week_of_year,
  CAST(month(timestamp) AS INTEGER) AS month,
  CAST(quarter(timestamp) AS INTEGER) AS quarter,
  CAST(year(timestamp) AS INTEGER) AS year,
  date_trunc('hour', timestamp) AS hour"""

FLAG_COLS = """day_of_week IN (5, 6) AS is_weekend,
  hour_of_day BETWEEN 7 AND 22 AS is_peak_hour,
  hour_of_day BETWEEN 9 AND 17 AS is_business_hour,
  CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
       WHEN month IN (6, 7, 8) THEN 'Summer' WHEN month IN (9, 10, 11) THEN 'Fall' END AS season,
  CASE WHEN day_of_week IN (5, 6) THEN 'Weekend' WHEN hour_of_day BETWEEN 7 AND 22 THEN 'Peak'
       ELSE 'Off-Peak' END AS time_period"""

T0 = f"t0 AS (SELECT *, {TIME_COLS} FROM c)"
T = f"t AS (SELECT *, {FLAG_COLS} FROM t0)"


def hourly_aggs(digits: int = 4) -> str:
    parts = []
    for c in PRICES:
        parts += [f"{rnd(f'avg({c})', digits)} AS {c}_mean_hourly",
                  f"{rnd(f'min({c})', digits)} AS {c}_min_hourly",
                  f"{rnd(f'max({c})', digits)} AS {c}_max_hourly",
                  f"{rnd(f'stddev_samp({c})', digits)} AS {c}_std_hourly",
                  f"count({c}) AS {c}_count_hourly"]
    return ",\n  ".join(parts)


H = f"h AS (SELECT location_id, hour, {hourly_aggs()} FROM t GROUP BY location_id, hour)"
J = "j AS (SELECT t.*, h.* EXCLUDE (location_id, hour) FROM t LEFT JOIN h USING (location_id, hour))"

DERIVED_COLS = f"""coalesce(lmp_total_std_hourly, 0.0) AS lmp_volatility_hourly,
  coalesce(coalesce(lmp_total_std_hourly, 0.0) >
     (SELECT quantile_cont(coalesce(lmp_total_std_hourly, 0.0), 0.75) FROM j), false) AS is_high_volatility,
  coalesce(congestion_component > 1.0, false) AS has_congestion,
  CASE WHEN congestion_component IS NULL THEN NULL WHEN congestion_component <= 0 THEN 'None'
       WHEN congestion_component <= 5 THEN 'Low' WHEN congestion_component <= 15 THEN 'Medium'
       ELSE 'High' END AS congestion_level,
  CASE WHEN lmp_total = 0 THEN (CASE WHEN loss_component > 0 THEN 100.0 WHEN loss_component < 0 THEN 0.0 END)
       ELSE least(greatest({rnd('loss_component / lmp_total * 100', 2)}, 0.0), 100.0) END AS loss_percentage,
  {rnd("(lmp_total - avg(lmp_total) OVER (PARTITION BY location_id, date)) / nullif(avg(lmp_total) OVER (PARTITION BY location_id, date), 0) * 100", 2)} AS price_vs_daily_avg,
  {rnd("(lmp_total - avg(lmp_total) OVER (PARTITION BY timestamp)) / nullif(avg(lmp_total) OVER (PARTITION BY timestamp), 0) * 100", 2)} AS price_vs_system_avg,
  {rnd("CAST(lmp_total_count_hourly AS DOUBLE) / 4 * 100", 1)} AS data_completeness_hourly"""

E0 = f"e0 AS (SELECT *, {DERIVED_COLS} FROM j)"
E = "e AS (SELECT *, coalesce(data_completeness_hourly = 100.0, false) AS is_complete_hour FROM e0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


READING_CHAIN = (R, D, C, T0, T, H, J, E0, E)

K = f"k AS ({KWH_SQL})"
