"""Exact discrete percentiles per group (the value at rank ceil(p * n)), distributed.

``percentile_disc`` keeps each group's value->count map in one task, and
``percentile_approx`` is exact only with a sketch as large as the group.  Here each
group's rank is located by narrowing a band, for all groups at once:

1. value counts per (group, value) -- a map-side-combined aggregate, materialized;
2. per (group, p): target rank k = ceil(p * n) and an open band (lo, hi];
3. while some band holds more than ``limit`` distinct values: approximate cut points
   per band (a bounded sketch), each row's segment = the number of cuts below its value
   (a higher-order function: no row x cut pairs), exact counts per segment, and the
   segment holding rank k becomes the new band;
4. bands within the bound are finished with a window per (group, p) over at most
   ``limit`` rows (a checked bound), taking the first value whose cumulative count
   reaches k.

The per-(group, p) state is a small table joined back (never collected).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.operators.common import join_small, materialize

LIMIT = 50_000
CUTS = 64
ACCURACY = 10_000
MAX_LEVELS = 32


def percentile_disc(df: DataFrame, groups: list[str], value: str, ps: list[float],
                    names: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per group with one column per p (value type kept).  ``groups`` must be
    non-empty (a global percentile is ``quantiles.exact_quantiles``); group keys are
    matched with equality, so a NULL group key gets no row."""
    if not groups:
        raise ValueError("percentile_disc needs at least one group column")
    names = names or [f"p{int(round(p * 100))}" for p in ps]
    vc = materialize(df.filter(F.col(value).isNotNull())
                     .groupBy(*groups, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    totals = materialize(vc.groupBy(*groups).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d")))
    widest = totals.agg(F.max("_d")).first()[0] or 0
    plist = F.array(*[F.struct(F.lit(i).alias("_pi"), F.lit(float(p)).alias("_p")) for i, p in enumerate(ps)])
    state = (totals.select(*groups, "_n", F.explode(plist).alias("_pp"))
             .select(*groups, F.col("_pp._pi").alias("_pi"),
                     F.greatest(F.lit(1), F.ceil(F.col("_pp._p") * F.col("_n"))).cast("long").alias("_k"),
                     F.lit(None).cast(vc.schema["_v"].dataType).alias("_lo"),
                     F.lit(None).cast(vc.schema["_v"].dataType).alias("_hi"),
                     F.lit(0).cast("long").alias("_below")))
    keys = [*groups, "_pi"]
    if widest <= limit:          # every group already within the bound: one window pass
        done = _finish(vc, state, groups)
    else:
        done, converged = None, False
        for _ in range(MAX_LEVELS):
            band = _band(vc, state, groups)
            sizes = band.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"))
            st = materialize(state.join(sizes, keys, "left").fillna(0, ["_d"]))
            small = st.filter(F.col("_d") <= limit).drop("_d")
            big = st.filter(F.col("_d") > limit).drop("_d")
            finished = _finish(vc, small, groups)
            done = finished if done is None else done.unionByName(finished)
            if big.isEmpty():
                converged = True
                break
            state = materialize(_narrow(vc, big, groups))
        if not converged:
            raise RuntimeError("percentile band search did not converge")
    wide = done.groupBy(*groups).pivot("_pi", list(range(len(ps)))).agg(F.first("_ans"))
    return wide.select(*groups, *[F.col(str(i)).alias(n) for i, n in enumerate(names)])


def _band(vc: DataFrame, state: DataFrame, groups: list[str]) -> DataFrame:
    """Rows of each (group, p) band: lo < v <= hi (NULL bounds are open)."""
    joined = join_small(vc, state, groups, "inner")
    inside = ((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo")))
              & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))))
    return joined.filter(inside)


def _finish(vc: DataFrame, small: DataFrame, groups: list[str]) -> DataFrame:
    """Bands of at most ``limit`` distinct values: cumulative counts in a window."""
    band = _band(vc, small, groups)
    w = (Window.partitionBy(*groups, "_pi").orderBy("_v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = band.withColumn("_cum", F.col("_below") + F.sum("_c").over(w))
    return (cum.filter(F.col("_cum") >= F.col("_k"))
            .groupBy(*groups, "_pi").agg(F.min("_v").alias("_ans")))


def _narrow(vc: DataFrame, big: DataFrame, groups: list[str]) -> DataFrame:
    """One narrowing step for the bands that are still too wide."""
    keys = [*groups, "_pi"]
    band = _band(vc, big, groups)
    fractions = [i / CUTS for i in range(1, CUTS)]
    cuts = materialize(band.groupBy(*keys)
                       .agg(F.array_sort(F.array_distinct(F.percentile_approx("_v", fractions, ACCURACY)))
                            .alias("_cuts")))
    # cut arrays: (groups x p) rows of <= 63 values, measured and broadcast, so a hot
    # group's band rows are never shuffled to one task
    seg = (join_small(band, cuts, keys, "inner")
           .withColumn("_seg", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
           .groupBy(*keys, "_seg").agg(F.sum("_c").alias("_sc"), F.max("_v").alias("_smax"),
                                       F.first("_cuts").alias("_cuts")))
    w = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = seg.join(big.select(*keys, "_below", "_k", "_lo", "_hi"), keys)
    seg = seg.withColumn("_cum", F.col("_below") + F.sum("_sc").over(w))
    # the first segment whose cumulative count reaches k holds the rank
    pick = (seg.filter(F.col("_cum") >= F.col("_k"))
            .groupBy(*keys).agg(F.min_by(F.struct("_seg", "_cum", "_sc", "_cuts"), F.col("_seg")).alias("_s")))
    prev = F.col("_s._cuts")[F.col("_s._seg") - 1]
    this = F.col("_s._cuts")[F.col("_s._seg")]
    out = pick.join(big.select(*keys, "_k", "_lo", "_hi"), keys).select(
        *keys, "_k",
        F.when(F.col("_s._seg") > 0, prev).otherwise(F.col("_lo")).alias("_lo"),
        F.when(F.col("_s._seg") < F.size(F.col("_s._cuts")), this).otherwise(F.col("_hi")).alias("_hi"),
        (F.col("_s._cum") - F.col("_s._sc")).alias("_below"))
    return out

