"""Input validation (PF1-PF3, PF8, SL3) returned as frames, not log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.numeric import coerce_double
from voltframe.functions.timefields import bad_time
from voltframe.schemas import CRITICAL_COLUMNS, REQUIRED_COLUMNS

# Plausible LMP range in $/MWh, inclusive; sample size of the outlier report.
LMP_RANGE = (-1000.0, 1000.0)
OUTLIER_SAMPLE = 5


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """PF1: decided at plan time from the schema."""
    return [c for c in (required or REQUIRED_COLUMNS) if c not in df.columns]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column (pandas counts both)."""
    c = F.col(name)
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def outlier_flag(df: DataFrame, col: str = "lmp_total", lo: float = LMP_RANGE[0],
                 hi: float = LMP_RANGE[1]) -> DataFrame:
    """PF3: flag (never drop) values outside [lo, hi]; NULL counts as outside, as a
    NaN does in the reference's negated ``between``."""
    return df.withColumn("is_outlier", ~F.coalesce(F.col(col).between(lo, hi), F.lit(False)))


def verdict_aggregates(df: DataFrame, lo: float = LMP_RANGE[0], hi: float = LMP_RANGE[1]) -> list:
    """The aggregate expressions of the verdict (usable in ``agg`` or ``observe``)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in CRITICAL_COLUMNS:
        # over no rows at all these are 0, over a missing column NULL
        aggs.append((F.count_if(is_missing(df, c)) if c in df.columns else F.max(F.lit(None).cast("long"))).alias(f"null_{c}"))
    aggs.append((F.count_if(bad_time(df, "timestamp")) if "timestamp" in df.columns else F.max(F.lit(None).cast("long")))
                .alias("rejected_times"))
    if "lmp_total" in df.columns:
        price = coerce_double(df, "lmp_total")     # landed text: bad values count as outside
        aggs.append(F.count_if(~F.coalesce(price.between(lo, hi), F.lit(False))).alias("outlier_count"))
    else:
        aggs.append(F.max(F.lit(None).cast("long")).alias("outlier_count"))
    return aggs


def verdict_from_counts(v: DataFrame, missing: list[str]) -> DataFrame:
    nulls = sum((F.coalesce(F.col(f"null_{c}"), F.lit(0)) for c in CRITICAL_COLUMNS), F.lit(0))
    return v.withColumns({
        "missing_columns": F.lit(",".join(missing)),
        "is_valid": F.lit(not missing) & (nulls == 0),
        "is_empty": F.col("row_count") == 0,   # PF8
    })


def batch_verdict(df: DataFrame, lo: float = LMP_RANGE[0], hi: float = LMP_RANGE[1]) -> DataFrame:
    """PF1+PF2+PF3 as one single-row frame: the whole batch passes only with all
    required columns and no NULL (or NaN) in a critical column.  ``rejected_times`` counts
    the texts that are no time; the cleaner leaves those rows out.  One aggregate pass."""
    return verdict_from_counts(df.agg(*verdict_aggregates(df, lo, hi)), missing_columns(df))


def observed_verdict(df: DataFrame, lo: float = LMP_RANGE[0], hi: float = LMP_RANGE[1]):
    """The verdict counted while ``df`` is consumed by some other job (an
    ``Observation``): returns (df_to_consume, finish) where ``finish()`` gives the
    one-row verdict frame once that job has run.  Saves a separate scan.  (If a stage
    is retried, re-run tasks may add to the counts: ``row_count`` can only grow and a
    zero NULL count stays zero, so the pass/reject decision is unaffected.)"""
    obs = Observation("batch_verdict")
    observed = df.observe(obs, *verdict_aggregates(df, lo, hi))
    missing = missing_columns(df)

    def finish() -> DataFrame:
        counts = obs.get
        spark = df.sparkSession
        names = ["row_count", "null_timestamp", "null_location_id", "null_lmp_total", "rejected_times", "outlier_count"]
        schema = ", ".join(f"{c} long" for c in names)
        row = [counts.get(c) for c in names]
        return verdict_from_counts(spark.createDataFrame([row], schema), missing)
    return observed, finish


def gate(df: DataFrame, verdict: DataFrame) -> DataFrame:
    """Keep the whole batch or nothing.  The verdict is one aggregate row (reading only
    the critical columns); its flag becomes a literal filter, which Catalyst folds: a
    rejected batch plans as an empty relation and is never scanned again."""
    ok = bool(verdict.select("is_valid").first()[0])
    return df.filter(F.lit(ok))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row-level alternative to the all-or-nothing gate: (good, rejected)."""
    bad = sum((is_missing(df, c).cast("int") for c in CRITICAL_COLUMNS), F.lit(0)) > 0
    return df.filter(~bad), df.filter(bad)


def outlier_sample(df: DataFrame, n: int = OUTLIER_SAMPLE, lo: float = LMP_RANGE[0],
                   hi: float = LMP_RANGE[1]) -> DataFrame:
    """SL3: a top-k sample of outliers (k is the feature), ordered by key for stability."""
    return (outlier_flag(df, "lmp_total", lo, hi).filter("is_outlier")
            .select("timestamp", "location_id", "lmp_total")
            .orderBy("timestamp", "location_id", "lmp_total").limit(n))
