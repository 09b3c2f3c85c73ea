"""Zone dimension (SRC6, SRC7) and the zone enrichment join (JN4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's lists).  Location ids 4000-4008 with names,
# and the eight load-zone codes; the two lists are in different orders in the
# reference, so codes are paired with ids by zone name, never by position.  The hub has
# no load-zone code.
ZONES = [
    (4000, "Hub", None),
    (4001, "Maine Load Zone", ".Z.MAINE"),
    (4002, "New Hampshire Load Zone", ".Z.NEWHAMPSHIRE"),
    (4003, "Vermont Load Zone", ".Z.VERMONT"),
    (4004, "Connecticut Load Zone", ".Z.CONNECTICUT"),
    (4005, "Rhode Island Load Zone", ".Z.RHODEISLAND"),
    (4006, "Southeast Massachusetts Load Zone", ".Z.SEMASS"),
    (4007, "Northeast Massachusetts Load Zone", ".Z.NEMASSBOST"),
    (4008, "Western/Central Massachusetts Load Zone", ".Z.WCMASS"),
]
LOAD_ZONES = [".Z.MAINE", ".Z.NEWHAMPSHIRE", ".Z.VERMONT", ".Z.CONNECTICUT", ".Z.RHODEISLAND",
              ".Z.SEMASS", ".Z.WCMASS", ".Z.NEMASSBOST"]

ZONE_SCHEMA = T.StructType([
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("zone_name", T.StringType()),
    T.StructField("location_code", T.StringType()),
])


def zones(spark: SparkSession) -> DataFrame:
    """SRC6: the 9-row zone dimension (a fixed, bounded table)."""
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


def load_zone_filter(col: str = "location_id"):
    """SRC7: predicate keeping the eight load zones."""
    return F.col(col).isin(LOAD_ZONES)


def enrich_with_zones(df: DataFrame, code_col: str = "location_id") -> DataFrame:
    """JN4: left join of the dimension by load-zone code (broadcast: 9 rows)."""
    dim = zones(df.sparkSession).filter(F.col("location_code").isNotNull())
    return df.join(F.broadcast(dim), df[code_col] == dim["location_code"], "left").drop("location_code")
