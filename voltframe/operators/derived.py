"""Derived indicators on enriched readings (MA4-MA11, WN1, WN2, DT16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.numeric import (
    EXPECTED_PER_HOUR, completeness, congestion_level, has_congestion, loss_percentage, pct_diff,
)

# Quantile that marks high volatility; processing version label.
VOLATILITY_QUANTILE = 0.75
DATA_VERSION = "1.0"


def add_derived_fields(df: DataFrame, volatility_threshold: float | None,
                       daily_avg: str = "_daily_avg", system_avg: str = "_system_avg",
                       expected_per_hour: int = EXPECTED_PER_HOUR,
                       processing_metadata: bool = False) -> DataFrame:
    """Needs the AG1 columns, a per-row zone-day mean and system mean (joined from the
    statistics tables) and the batch volatility quantile as a scalar."""
    vol = F.coalesce(F.col("lmp_total_std_hourly"), F.lit(0.0))
    thr = F.lit(volatility_threshold).cast("double")
    out = df.withColumns({
        "lmp_volatility_hourly": vol,
        "is_high_volatility": F.coalesce(vol > thr, F.lit(False)),
        "has_congestion": has_congestion(F.col("congestion_component")),
        "congestion_level": congestion_level(F.col("congestion_component")),
        "loss_percentage": loss_percentage(F.col("loss_component"), F.col("lmp_total")),
        "price_vs_daily_avg": pct_diff(F.col("lmp_total"), F.col(daily_avg)),
        "price_vs_system_avg": pct_diff(F.col("lmp_total"), F.col(system_avg)),
        "data_completeness_hourly": completeness(F.col("lmp_total_count_hourly"), expected_per_hour),
    }).withColumn("is_complete_hour", F.coalesce(F.col("data_completeness_hourly") == 100.0, F.lit(False)))
    if processing_metadata:
        out = out.withColumns({
            "processing_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "data_version": F.lit(DATA_VERSION),
        })
    return out
