"""Ingest run log: source resolution (JN3), selection (PF6) and audit (AG16).

The reference keeps counters in memory per run; here the run log is a table (one row
per source per run) and the audit is a group-by over it, so any number of runs is
summarised in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.formats import folder_name
from voltframe.functions.numeric import round_to
from voltframe.operators.common import join_small

# The source catalogue (name, output folder, file prefix) and the
# fallbacks for an unknown source (folder = lower-cased name with '_', prefix 'data').
SOURCE_CATALOGUE = [
    ("7 day forecast all zones", "iso_ne_current_7_day_forecast", "demand"),
    ("Hourly DA LMP Final", "hourly_final_lmp", "hourly_final_lmp"),
    ("iso_ne_fuel_mix", "iso_ne_fuel_mix", "fuel_mix"),
    ("Morning Report", "iso_ne_morning_report", "morning_report"),
]
DEFAULT_PREFIX = "data"

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("api_name", T.StringType()),
    T.StructField("output_folder", T.StringType()),
    T.StructField("csv_prefix", T.StringType()),
])


def source_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE_CATALOGUE, CATALOGUE_SCHEMA)


def resolve_sources(run_log: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """JN3: attach folder and file prefix from the catalogue, with the fallbacks.
    The built-in catalogue has a handful of rows: broadcast; one of the caller's only if its
    measured size allows."""
    cat = F.broadcast(source_catalogue(run_log.sparkSession)) if catalogue is None else catalogue
    joined = run_log.join(cat, "api_name", "left") if catalogue is None else join_small(run_log, cat, "api_name")
    return (joined.withColumn("folder_path", F.coalesce(F.col("output_folder"), folder_name(F.col("api_name"))))
            .withColumn("file_prefix", F.coalesce(F.col("csv_prefix"), F.lit(DEFAULT_PREFIX)))
            .drop("output_folder", "csv_prefix"))


def select_sources(run_log: DataFrame, names: list[str]) -> DataFrame:
    """PF6: a selective run is a filter on the source name."""
    return run_log.filter(F.col("api_name").isin(names))


def ingest_audit(run_log: DataFrame, by: list[str] | None = None, label: str | None = None) -> DataFrame:
    """AG16: per run, totals, successes and failures of collection and upload, the
    collection rate ok / max(total, 1), the upload rate up / ok (0 without successes)
    and the run duration.  ``label`` (e.g. a region) only labels the summary rows."""
    by = by or ["run_id"]
    ok = F.count_if(F.col("collection_status") == "success")
    up = F.count_if(F.col("upload_status") == "success")
    agg = run_log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_apis"),
        ok.alias("successful_collections"),
        F.count_if(F.col("collection_status") != "success").alias("failed_collections"),
        up.alias("successful_uploads"),
        F.count_if(F.col("upload_status") == "failed").alias("failed_uploads"),
        (F.unix_seconds(F.max(F.col("timestamp").cast("timestamp")))
         - F.unix_seconds(F.min(F.col("timestamp").cast("timestamp")))).alias("duration_seconds"),
    )
    out = agg.withColumns({
        "collection_success_rate": round_to(F.col("successful_collections")
                                            / F.greatest(F.col("total_apis"), F.lit(1)), 4),
        "upload_success_rate": round_to(F.when(F.col("successful_collections") > 0,
                                               F.col("successful_uploads") / F.col("successful_collections"))
                                        .otherwise(F.lit(0.0)), 4),
        "successful_end_to_end": F.col("successful_uploads"),
    })
    return out if label is None else out.withColumn("region", F.lit(label))


def selective_summary(run_log: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """PF6 + AG16 for a selective run: per run, uploads that succeeded among the
    selected sources, the number of sources asked for, and their ratio (0 when none
    were asked for)."""
    by = by or ["run_id"]
    asked = len(names)
    agg = select_sources(run_log, names).groupBy(*by).agg(
        F.count_if(F.col("upload_status") == "success").alias("successful_count"))
    rate = F.col("successful_count") / F.lit(float(asked)) if asked else F.lit(0.0)
    return agg.withColumns({"total_count": F.lit(asked), "success_rate": round_to(rate, 4)})
