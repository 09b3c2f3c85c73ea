"""Exact quantiles at scale (AG8, AG9) without a single-reducer value map.

``percentile`` keeps a value->count map for the whole column in one final task, which
does not survive a high-cardinality column at 100 TB.  Here a sketch of the column (one scan,
bounded size) brackets each rank first, a second scan counts what lies below and inside the
brackets, and only the values inside, a few ten-thousandths of the rows, are reduced to a
value-count table (hash aggregate with map-side combine, so one hot value costs one row).  In
that table the rank is located by narrowing a band: approximate cut points split it, exact
weighted counts pick the sub-band holding the rank, and only a band whose distinct-value count
is under a checked bound is brought to the driver.  Sketches and cut points only steer the
search: a rank outside its bracket widens it to everything, and the answer is exact.
Interpolation is linear (pandas ``quantile``, DuckDB ``quantile_cont``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.operators.common import materialize

COLLECT_LIMIT = 50_000   # distinct values a band may hold before it is collected
CUTS = 64                # sub-bands per narrowing pass
APPROX_ACCURACY = 10_000
BRACKET = 4 / APPROX_ACCURACY    # of the rows, on either side of a rank


def value_counts(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Materialized (v double, c long) table of non-null values and their weights."""
    v = F.col(value).cast("double")
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    vc = (df.select(v.alias("v"), w.alias("c"))
          .filter(F.col("v").isNotNull() & ~F.isnan("v"))
          .groupBy("v").agg(F.sum("c").alias("c")))
    return materialize(vc)


def _band(vc: DataFrame, lo, hi) -> DataFrame:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("v") > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col("v") <= F.lit(hi))
    return vc.filter(cond)


MAX_LEVELS = 32


def _resolve(vc: DataFrame, lo, hi, below: int, ranks: list[int], out: dict, limit: int,
             n_distinct: int | None = None, level: int = 0) -> None:
    if level > MAX_LEVELS:
        raise RuntimeError("quantile band search did not converge")
    band = _band(vc, lo, hi)
    n_distinct = band.count() if n_distinct is None else n_distinct
    if n_distinct <= limit:
        rows = band.orderBy("v").collect()          # bounded by the check above
        cum, i = below, 0
        todo = sorted(ranks)
        for r in rows:
            cum += r["c"]
            while i < len(todo) and todo[i] < cum:
                out[todo[i]] = r["v"]
                i += 1
        return
    fractions = [i / CUTS for i in range(1, CUTS)]
    cuts = band.agg(F.percentile_approx("v", fractions, APPROX_ACCURACY)).first()[0]
    cuts = sorted(set(cuts))
    counts = band.agg(*[F.sum(F.when(F.col("v") <= F.lit(c), F.col("c")).otherwise(0)).alias(f"n{i}")
                        for i, c in enumerate(cuts)]).first()
    bounds = [lo] + cuts + [hi]
    cum = [below] + [below + int(counts[f"n{i}"]) for i in range(len(cuts))]
    for j in range(len(bounds) - 1):
        seg_lo, seg_hi, seg_below = bounds[j], bounds[j + 1], cum[j]
        seg_top = cum[j + 1] if j < len(cuts) else None
        mine = [r for r in ranks if r >= seg_below and (seg_top is None or r < seg_top)]
        if mine:
            _resolve(vc, seg_lo, seg_hi, seg_below, mine, out, limit, level=level + 1)


def quantiles_from_counts(vc: DataFrame, qs: list[float], limit: int = COLLECT_LIMIT) -> list[float | None]:
    total, n_distinct = vc.agg(F.sum("c"), F.count(F.lit(1))).first()   # vc is materialized: a cheap scan
    if not total:
        return [None] * len(qs)
    wanted = _ranks(total, qs)
    ranks = sorted({k for _, k1, k2 in wanted.values() for k in (k1, k2)})
    found: dict = {}
    _resolve(vc, None, None, 0, ranks, found, limit, n_distinct)
    out = []
    for q in qs:
        h, k1, k2 = wanted[q]
        v1, v2 = found[k1], found[k2]
        out.append(v1 + (v2 - v1) * (h - k1))
    return out


def _ranks(total: int, qs: list[float]) -> dict[float, tuple[float, int, int]]:
    """Place of each quantile among ``total`` sorted values, and the ranks around it."""
    return {q: ((total - 1) * q, math.floor((total - 1) * q), math.ceil((total - 1) * q)) for q in qs}


def _bracketed(values: DataFrame, qs: list[float], limit: int) -> list[float | None]:
    """Exact quantiles of the column ``v`` (no NULL, no NaN): sketch, count, then resolve."""
    marks = sorted({min(1.0, max(0.0, q + side * BRACKET)) for q in qs for side in (-1, 1)})
    total, cuts = values.agg(F.count("v"), F.percentile_approx("v", marks, APPROX_ACCURACY)).first()
    if not total:
        return [None] * len(qs)
    cut, places = dict(zip(marks, cuts)), _ranks(total, qs)
    # a band excludes its lower end, so that end is the number just below the sketch's
    ends = {q: (math.nextafter(cut[max(0.0, q - BRACKET)], -math.inf), cut[min(1.0, q + BRACKET)]) for q in qs}
    counted = values.agg(*[F.count_if(F.col("v") <= F.lit(end)).alias(f"n{i}{side}")
                           for i, q in enumerate(qs) for side, end in enumerate(ends[q])]).first()
    below = {}
    for i, q in enumerate(qs):
        _, first, last = places[q]
        below[q] = int(counted[f"n{i}0"])
        if not below[q] <= first <= last < int(counted[f"n{i}1"]):
            ends[q], below[q] = (None, None), 0
    inside = F.lit(False)
    for lo, hi in ends.values():
        inside = inside | (F.lit(True) if lo is None else (F.col("v") > F.lit(lo)) & (F.col("v") <= F.lit(hi)))
    vc, out = value_counts(values.filter(inside), "v"), []
    for q in qs:
        found: dict = {}
        place, first, last = places[q]
        _resolve(vc, *ends[q], below[q], sorted({first, last}), found, limit)
        out.append(found[first] + (found[last] - found[first]) * (place - first))
    return out


def _numbers(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.select(v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def exact_quantiles(df: DataFrame, value: str, qs: list[float], weight: str | None = None,
                    limit: int = COLLECT_LIMIT) -> list[float | None]:
    """Exact linear-interpolated quantiles of a column.  With ``weight`` the input is a table
    of counts already, and its ranks are resolved without a sketch."""
    if weight:
        return quantiles_from_counts(value_counts(df, value, weight), qs, limit)
    return _bracketed(_numbers(df, value), qs, limit)


def exact_quantiles_bounded(df: DataFrame, value: str, qs: list[float], rows: int,
                            weight: str | None = None, limit: int = COLLECT_LIMIT) -> list[float | None]:
    """Exact quantiles when the input's row count is known: within ``limit`` rows,
    Spark's ``percentile`` (one aggregate; its value map is bounded by the row count);
    beyond it, the band search."""
    if rows > limit:
        return exact_quantiles(df, value, qs, weight, limit)
    freq = F.col(weight).cast("long") if weight else F.lit(1)
    v = F.col(value).cast("double")
    kept = df.filter(v.isNotNull() & ~F.isnan(v))
    out = kept.agg(F.percentile(v, qs, freq)).first()[0]
    return list(out) if out is not None else [None] * len(qs)


def approx_quantiles(df: DataFrame, value: str, qs: list[float], accuracy: int = APPROX_ACCURACY) -> list:
    """AG8 opt-in: one sketch pass (rank error <= n / accuracy), values from the data."""
    row = df.agg(F.percentile_approx(F.col(value).cast("double"), qs, accuracy)).first()[0]
    return list(row) if row is not None else [None] * len(qs)


def median_and_mad(df: DataFrame, value: str, limit: int = COLLECT_LIMIT) -> tuple:
    """AG9: median, then the median of absolute deviations, both exact; the deviations are
    computed as they are scanned."""
    values = _numbers(df, value)
    (med,) = _bracketed(values, [0.5], limit)
    if med is None:
        return None, None
    (mad,) = _bracketed(values.select(F.abs(F.col("v") - F.lit(med)).alias("v")), [0.5], limit)
    return med, mad
