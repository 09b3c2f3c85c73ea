"""Shared plan helpers: lineage cuts and size-checked broadcast joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.session import checkpoint_root, scratch_path

# A side is broadcast only when its measured size (rows x estimated row width) is
# under this bound; beyond it the join stays a shuffle join and AQE splits skewed
# partitions of the big side.
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a small derived table (statistics, value counts) with a reliable
    checkpoint in the shared folder named by ``spark.checkpoint.dir``: one job, and
    the data survives executor loss because it does not live on an executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage a large intermediate (row-level) as a parquet table in the shared folder
    and read it back.  Later readers get a columnar, pruned, pushed-down scan instead
    of recomputing the upstream shuffle."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _row_width(schema: T.StructType) -> int:
    width = 16
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, (T.StringType, T.BinaryType)):
            width += 48
        elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            width += 128
        else:
            width += 8
    return width


def fits_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, rows: int | None = None) -> bool:
    """Measure a (materialized) side: row count times estimated width.  ``rows`` is a
    count already known exactly (saves the counting job)."""
    n = small.count() if rows is None else rows
    return n * _row_width(small.schema) <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_bytes: int = MAX_BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """Join a materialized statistics table back onto the big side.

    Broadcast when the measured size allows (no shuffle of the big side at all),
    otherwise a plain equi-join that AQE plans as sort-merge with skew splitting."""
    side = F.broadcast(small) if fits_broadcast(small, max_bytes, rows) else small
    return big.join(side, on, how)

