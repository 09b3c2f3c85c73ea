"""Numeric coercion, rounding and derived price indicators (MA1-MA16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's rules):
#   congestion flag: congestion_component > 1.0
#   congestion level bins, right-closed: (-inf, 0] None, (0, 5] Low, (5, 15] Medium, (15, inf) High
#   expected readings per hour: 4 (15-minute feed)
#   loss percentage clipped to [0, 100]
#   MW to kW factor 1000
CONGESTION_FLAG_THRESHOLD = 1.0
CONGESTION_BINS = ((0.0, "None"), (5.0, "Low"), (15.0, "Medium"))
CONGESTION_TOP = "High"
EXPECTED_PER_HOUR = 4
MW_TO_KW = 1000.0


SNAP_DIGITS = 9


def _scaled_round(c: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.round(c * scale, 0) / scale


def round_to(c: Column, digits: int) -> Column:
    """MA3: round on the binary value scaled by 10^digits (what pandas/numpy and DuckDB
    do), not on the shortest decimal text (Spark's ``round`` on doubles); ties of the
    scaled value go away from zero.

    The value is first snapped to 9 decimals: different engines (and different input
    orders) leave last-bit noise in means and variances, and a statistic sitting on a
    rounding tie would otherwise round either way.  The oracle SQL writes the same
    ``round(round(x, 9), d)``."""
    if digits >= SNAP_DIGITS:
        return _scaled_round(c, digits)
    return _scaled_round(_scaled_round(c, SNAP_DIGITS), digits)


def nan_to_null(c: Column) -> Column:
    """pandas NaN becomes SQL NULL once at the entry (Spark orders NaN above all numbers)."""
    return F.nanvl(c, F.lit(None).cast("double"))


def coerce_double(df: DataFrame, name: str) -> Column:
    """MA1: numeric coercion; bad text -> NULL (never raises under ANSI)."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.StringType):
        c = F.expr(f"try_cast(trim(`{name}`) AS DOUBLE)")
    else:
        c = c.cast("double")
    return nan_to_null(c)


def clip(c: Column, lo: float, hi: float) -> Column:
    """MA4: clip, NULL stays NULL."""
    return F.when(c.isNull(), None).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def loss_percentage(loss: Column, lmp: Column) -> Column:
    """MA5: clip(round(loss / lmp * 100, 2), 0, 100).

    Division by zero follows the reference's infinities through the clip: lmp = 0 gives
    100 when loss > 0, 0 when loss < 0, NULL when loss = 0 (0/0)."""
    ratio = round_to(F.try_divide(loss, lmp) * 100, 2)
    return (F.when(lmp == 0, F.when(loss > 0, 100.0).when(loss < 0, 0.0))
            .otherwise(clip(ratio, 0.0, 100.0)))


def pct_diff(x: Column, ref: Column, digits: int = 2) -> Column:
    """WN1/WN2 percentage difference from a reference mean; mean 0 -> NULL."""
    return round_to(F.try_divide(x - ref, ref) * 100, digits)


def congestion_level(c: Column) -> Column:
    """MA9: right-closed bins (a left-closed Bucketizer would misplace 0, 5 and 15)."""
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for upper, label in CONGESTION_BINS:
        expr = expr.when(c <= upper, label)
    return expr.otherwise(CONGESTION_TOP)


def has_congestion(c: Column) -> Column:
    """MA8."""
    return F.coalesce(c > CONGESTION_FLAG_THRESHOLD, F.lit(False))


def completeness(count: Column, expected_per_hour: int = EXPECTED_PER_HOUR) -> Column:
    """MA10: may exceed 100 when an hour holds more readings than expected."""
    return round_to(count / F.lit(float(expected_per_hour)) * 100, 1)
