"""Price anomaly flags (MA12-MA15, JN2).

Statistics are exact scalars (``quantiles.py`` for quantiles and MAD, one aggregate
for mean/std) and reach the rows as literals: a one-value broadcast with no join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.operators.quantiles import approx_quantiles, exact_quantiles, median_and_mad

METHODS = ("iqr", "zscore", "modified_zscore")
# Fixed value: scale of the modified z-score.
MODIFIED_Z_SCALE = 0.6745


def anomaly_bounds(df: DataFrame, price_col: str = "lmp_total", method: str = "iqr",
                   approx: bool = False) -> dict:
    """The batch statistics a method needs, as Python scalars.  ``approx`` swaps the
    exact quantiles for one bounded-sketch pass (AG8 opt-in)."""
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    if method == "iqr":
        quant = approx_quantiles if approx else exact_quantiles
        q1, q3 = quant(df, price_col, [0.25, 0.75])
        return {"q1": q1, "q3": q3}
    if method == "zscore":
        row = df.agg(F.avg(price_col).alias("mean"), F.stddev_samp(price_col).alias("std")).first()
        return {"mean": row["mean"], "std": row["std"]}
    if approx:
        (med,) = approx_quantiles(df, price_col, [0.5])
        if med is None:
            return {"median": None, "mad": None}
        dev = df.select(F.abs(F.col(price_col) - F.lit(med)).alias("_dev"))
        (mad,) = approx_quantiles(dev, "_dev", [0.5])
        return {"median": med, "mad": mad}
    med, mad = median_and_mad(df, price_col)
    return {"median": med, "mad": mad}


def flag_anomalies(df: DataFrame, price_col: str = "lmp_total", method: str = "iqr",
                   threshold: float = 3.0, out_col: str = "is_anomaly", approx: bool = False) -> DataFrame:
    s = anomaly_bounds(df, price_col, method, approx)
    p = F.col(price_col)
    lit = lambda v: F.lit(v).cast("double")
    if method == "iqr":
        if s["q1"] is None:
            flag = F.lit(False)
        else:
            iqr = s["q3"] - s["q1"]
            flag = (p < lit(s["q1"] - threshold * iqr)) | (p > lit(s["q3"] + threshold * iqr))
    elif method == "zscore":
        if s["std"] is None or s["std"] == 0:
            flag = F.lit(False)   # x/0 is inf only off the mean, and std 0 means no such row
        else:
            flag = F.abs((p - lit(s["mean"])) / lit(s["std"])) > lit(threshold)
    else:
        if s["median"] is None:
            flag = F.lit(False)
        elif s["mad"] == 0:
            flag = p != lit(s["median"])  # x/0 = inf off the median, 0/0 on it
        else:
            flag = F.abs(lit(MODIFIED_Z_SCALE) * (p - lit(s["median"])) / lit(s["mad"])) > lit(threshold)
    return df.withColumn(out_col, F.coalesce(flag, F.lit(False)))
