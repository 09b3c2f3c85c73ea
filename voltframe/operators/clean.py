"""Cleaning of landed readings: parse, keep-first dedup, trim, coerce, fill (WN4, ST1,
MA1, MA2, DT1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.numeric import coerce_double
from voltframe.functions.timefields import bad_time, parse_timestamp
from voltframe.schemas import DEDUP_KEYS, PRICE_COLUMNS

DEFAULT_ORDER = ["extraction_time", *PRICE_COLUMNS]


def _order_struct(order: list[str]) -> Column:
    # ascending, NULLs last for every ordering column
    parts = []
    for name in order:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.struct(*parts)


def dedup_first(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """WN4: keep one row per key, the first by ``order`` (NULLs last).

    Written as an aggregate (``min_by`` over a struct) rather than a ``row_number``
    window: the hash aggregate combines map-side, so a key holding a third of all rows
    collapses to one row per map task before the shuffle instead of landing whole in
    one window task."""
    keys = keys or DEDUP_KEYS
    order = [c for c in (order or DEFAULT_ORDER) if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = F.min_by(F.struct(*rest), _order_struct(order)).alias("_first")
    out = df.groupBy(*keys).agg(picked).select(*keys, "_first.*")
    return out.select(*df.columns)


def ensure_timestamp(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    if isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, parse_timestamp(F.col(name), strict))
    return df


def coerce_prices(df: DataFrame, trim_ids: bool = True) -> DataFrame:
    """ST1 + MA1 + MA2 without the dedup: trim ids/names, coerce prices, fill 0."""
    if trim_ids:
        df = df.withColumns({c: F.trim(c) for c in ("location_id", "location_name") if c in df.columns})
    df = df.withColumns({c: coerce_double(df, c) for c in PRICE_COLUMNS})
    return df.fillna(0.0, subset=PRICE_COLUMNS)


def clean_readings(df: DataFrame, order: list[str] | None = None, trim_first: bool = False,
                   strict_time: bool = False) -> DataFrame:
    """Clean a reading batch in the reference order: parse time, dedup on
    (timestamp, location_id) keeping the first, trim ids/names, coerce the four price
    columns to double (bad -> NULL) and fill NULL prices with 0.

    Rows whose time is text but no time are left out before the dedup (``bad_times`` returns
    them, the report and the verdict count them); ``strict_time`` fails instead.

    ``trim_first`` trims before dedup (the reference dedups first, so ' A' and 'A' are
    kept apart there)."""
    if "location_name" not in df.columns:
        df = df.withColumn("location_name", F.lit(None).cast("string"))
    if not strict_time:
        df = df.filter(~bad_time(df, "timestamp"))
    df = ensure_timestamp(df, "timestamp", strict_time)
    if "extraction_time" in df.columns:
        df = ensure_timestamp(df, "extraction_time", strict_time)
    trims = {"location_name": F.trim("location_name"), "location_id": F.trim("location_id")}
    if trim_first:
        df = df.withColumns(trims)
    df = dedup_first(df, DEDUP_KEYS, order)
    if not trim_first:
        df = df.withColumns(trims)
    df = df.withColumns({c: coerce_double(df, c) for c in PRICE_COLUMNS})
    return df.fillna(0.0, subset=PRICE_COLUMNS)


def bad_times(df: DataFrame) -> DataFrame:
    """The rows that cleaning rejects: their time is text but no time."""
    return df.filter(bad_time(df, "timestamp"))


def cleaning_report(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """AG18: times rejected, duplicates removed, and per price column the values coerced to
    NULL and the NULLs filled with 0 (counted after the dedup, as the reference logs them).

    One chain: the keep-first aggregate also counts rows per key, so input rows are
    the sum of the per-key counts and output rows the number of keys.  Rejected rows share
    one key of their own, of which nothing but the count is used."""
    rejected = bad_time(raw, "timestamp")
    raw = ensure_timestamp(raw.withColumn("_rejected", rejected), "timestamp")
    raw = raw.withColumn("location_id", F.when(~F.col("_rejected"), F.col("location_id")))
    keys = ["_rejected", *DEDUP_KEYS]
    order = [c for c in (order or DEFAULT_ORDER) if c in raw.columns]
    rest = [c for c in raw.columns if c not in keys]
    per_key = (raw.groupBy(*keys)
               .agg(F.min_by(F.struct(*rest), _order_struct(order)).alias("_first"), F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_first.*", "_n"))
    kept = ~F.col("_rejected")
    return per_key.agg(
        *[F.count_if(kept & F.col(c).isNotNull() & coerce_double(per_key, c).isNull()).alias(f"{c}_coerced")
          for c in PRICE_COLUMNS],
        *[F.count_if(kept & coerce_double(per_key, c).isNull()).alias(f"{c}_filled") for c in PRICE_COLUMNS],
        F.count_if(kept).alias("output_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(F.col("_rejected"), F.col("_n"))), F.lit(0)).alias("rejected_times"),
    ).withColumn("duplicates_removed", F.col("input_rows") - F.col("output_rows") - F.col("rejected_times"))
