"""Calendar and market-period fields (DT1-DT17) as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's rules):
#   season by month: 12, 1, 2 Winter; 3, 4, 5 Spring; 6, 7, 8 Summer; 9, 10, 11 Fall
#   weekend days (0 = Monday): 5, 6
#   peak hours: 7 to 22 inclusive; business hours: 9 to 17 inclusive
#   day/night on the two-digit hour text: '06' to '18' inclusive is Day
#   time period labels: Weekend, Peak, Off-Peak
SEASON_BY_MONTH = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                   6: "Summer", 7: "Summer", 8: "Summer", 9: "Fall", 10: "Fall", 11: "Fall"}
WEEKEND_DAYS = (5, 6)
PEAK_HOURS = (7, 22)
BUSINESS_HOURS = (9, 17)
DAY_HOURS_TEXT = ("06", "18")


def _is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def parse_timestamp(c: Column, strict: bool = False) -> Column:
    """DT1: text to timestamp.  Lenient form yields NULL for bad text (rejected and counted
    by the cleaner); ``strict`` raises like the reference batch does."""
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def bad_time(df: DataFrame, name: str) -> Column:
    """Text that is no time.  NULL is a missing time, not a bad one."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return F.col(name).isNotNull() & parse_timestamp(F.col(name)).isNull()


def floor_to_seconds(df: DataFrame, name: str, seconds: int) -> Column:
    """Floor a timestamp column to a multiple of ``seconds`` since the epoch, keeping
    its type (timestamp or timestamp_ntz) and its NULLs."""
    ntz = _is_ntz(df, name)
    step = seconds * 1_000_000
    micros = F.unix_micros(F.col(name).cast("timestamp"))
    floored = F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))
    return floored.cast("timestamp_ntz") if ntz else floored


def floor_hour(df: DataFrame, name: str) -> Column:
    """DT8: floor to the hour, same type as the input."""
    c = F.date_trunc("hour", F.col(name))
    return c.cast("timestamp_ntz") if _is_ntz(df, name) else c


def season(month: Column) -> Column:
    """DT12 season from month number."""
    expr = None
    for label in ("Winter", "Spring", "Summer", "Fall"):
        months = [m for m, s in SEASON_BY_MONTH.items() if s == label]
        cond = month.isin(months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def time_period(is_weekend: Column, is_peak: Column) -> Column:
    """DT13: Weekend, else Peak for peak hours, else Off-Peak."""
    return F.when(is_weekend, "Weekend").when(is_peak, "Peak").otherwise("Off-Peak")


def add_time_fields(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """DT2-DT13 in one projection (no shuffle)."""
    t = F.col(ts)
    df = df.withColumns({
        "date": F.date_format(t, "yyyy-MM-dd"),
        "hour_of_day": F.hour(t),
        "minute_of_hour": F.minute(t),
        "day_of_week": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t),
        "month": F.month(t),
        "quarter": F.quarter(t),
        "year": F.year(t),
        "hour": floor_hour(df, ts),
    })
    return df.withColumns({
        "is_weekend": F.coalesce(F.col("day_of_week").isin(list(WEEKEND_DAYS)), F.lit(False)),
        "is_peak_hour": F.coalesce(F.col("hour_of_day").between(*PEAK_HOURS), F.lit(False)),
        "is_business_hour": F.coalesce(F.col("hour_of_day").between(*BUSINESS_HOURS), F.lit(False)),
        "season": season(F.col("month")),
    }).withColumn("time_period", time_period(F.col("is_weekend"), F.col("is_peak_hour")))


def day_or_night(ts: Column) -> Column:
    """DT14: compares the two-digit hour text, so Day runs to 18:59."""
    hh = F.date_format(ts, "HH")
    return F.when(hh.between(*DAY_HOURS_TEXT), "Day").otherwise("Night")


def yyyymmdd(d: Column) -> Column:
    """DT17 date as yyyyMMdd text."""
    return F.date_format(d, "yyyyMMdd")


def pull_window(as_of: Column | None = None) -> Column:
    """DT17 request window: yesterday and today as yyyyMMdd (``as_of`` defaults to
    the current date), as a struct (start, end)."""
    today = as_of if as_of is not None else F.current_date()
    return F.struct(yyyymmdd(F.date_sub(today, 1)).alias("start"), yyyymmdd(today).alias("end"))
