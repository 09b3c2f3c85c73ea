"""Nested generation-mix payloads to a flat kWh series (SRC3, MA16, PL2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.numeric import MW_TO_KW, round_to

# GenMw is read as text and cast, so numbers and numeric strings both load.
GENMIX_TEXT = T.StructType([
    T.StructField("GenMixes", T.ArrayType(T.StructType([
        T.StructField("GenMixs", T.ArrayType(T.StructType([
            T.StructField("BeginDate", T.StringType()),
            T.StructField("GenMw", T.StringType()),
        ]))),
    ]))),
])


def genmix_records(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """SRC3: two array levels to (DateTime text, kWh); a missing BeginDate becomes '',
    a missing GenMw becomes 0, a missing inner array yields no rows; MW -> kW."""
    parsed = payloads.select(F.from_json(json_col, GENMIX_TEXT).alias("p"))
    mixes = parsed.select(F.explode("p.GenMixes").alias("m"))
    rows = mixes.select(F.explode("m.GenMixs").alias("g"))
    mw = F.coalesce(F.expr("try_cast(g.GenMw AS DOUBLE)"), F.lit(0.0))
    return rows.select(F.coalesce(F.col("g.BeginDate"), F.lit("")).alias("DateTime"),
                       (mw * F.lit(MW_TO_KW)).alias("kWh"))


def read_genmix(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one JSON document per file."""
    return genmix_records(spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload"))


def transform_kwh(records: DataFrame) -> DataFrame:
    """PL2 transform: parse the time, round kWh to tenths, drop fully equal rows.  A time is
    the instant that its zone offset names, in UTC, so the two hours of a clock that is set
    back stay apart.  (Sorting belongs to the sink.)"""
    return (records.select(F.expr("try_cast(DateTime AS TIMESTAMP)").cast("timestamp_ntz").alias("DateTime"),
                           round_to(F.col("kWh"), 1).alias("kWh"))
            .distinct())
