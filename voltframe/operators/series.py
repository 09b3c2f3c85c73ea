"""Global ordered LAG/LEAD without a single-partition window (WN3).

``LAG(x) OVER (ORDER BY t)`` has no PARTITION BY, so Spark plans ``Exchange
SinglePartition``: the whole series in one task.  Here the series is range-partitioned
on the ordering key (sampled bounds, so dense stretches of time split across tasks),
each partition computes its own lag/lead on Arrow batches (``mapInArrow``: zero-copy
slices, no pandas conversion), and only the first and last
row of every partition look across a boundary.  The pass is staged once with its partition
ids; the boundary table is read from it and has one row per partition (a proven bound), so it is
broadcast.  One shuffle in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.operators.common import stage_table


def _edge_fn(value: str, prev: str, nxt: str):
    """Per range partition: previous/next value inside the partition, computed on Arrow
    batches with zero-copy slices (no pandas conversion, decimals stay decimal128).
    One batch is held back so the last row of a batch can see the next batch's first
    value; the partition's first and last rows are flagged for stitching."""
    import numpy as np
    import pyarrow as pa

    def emit(batch, prev_before, starts, next_after, ends):
        n = batch.num_rows
        v = batch.column(batch.schema.get_field_index(value))
        head = pa.array([None if starts else prev_before], type=v.type)
        tail = pa.array([None if ends else next_after], type=v.type)
        p = pa.concat_arrays([head, v.slice(0, n - 1)])
        q = pa.concat_arrays([v.slice(1), tail])
        first = np.zeros(n, dtype=bool)
        last = np.zeros(n, dtype=bool)
        first[0], last[-1] = starts, ends
        cols = list(batch.columns) + [p, q, pa.array(first), pa.array(last)]
        names = list(batch.schema.names) + [prev, nxt, "_first", "_last"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def fn(batches):
        held, carry, started = None, None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            col = batch.column(batch.schema.get_field_index(value))
            if held is not None:
                yield emit(held[0], held[1], held[2], col[0].as_py(), False)
            held = (batch, carry, not started)
            started = True
            carry = col[batch.num_rows - 1].as_py()
        if held is not None:
            yield emit(held[0], held[1], held[2], None, True)
    return fn


def global_lag_lead(df: DataFrame, order: list[str], value: str, prev: str = "prev",
                    nxt: str = "next", partitions: int | None = None) -> DataFrame:
    """Previous and next ``value`` in the global order ``order`` (ascending; ties are
    broken by the remaining columns of ``order``, so list a tiebreak)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    vtype = df.schema[value].dataType
    out_schema = T.StructType(ranged.schema.fields + [
        T.StructField(prev, vtype), T.StructField(nxt, vtype),
        T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType()),
    ])
    # staged: range bounds are sampled anew by every job that plans the exchange, so the
    # boundary rows must come from the very partitions that the row pass has seen
    rows = stage_table(ranged.mapInArrow(_edge_fn(value, prev, nxt), out_schema), "lag-lead")
    bounds = (rows.filter("_first OR _last").groupBy("_pid")
              .agg(F.max(F.when(F.col("_first"), F.struct(value))).alias("_head"),
                   F.max(F.when(F.col("_last"), F.struct(value))).alias("_tail")))
    w = Window.orderBy("_pid")          # one row per partition: a bounded, tiny window
    bounds = bounds.select("_pid", F.lag(F.col("_tail")[value]).over(w).alias("_prev_tail"),
                           F.lead(F.col("_head")[value]).over(w).alias("_next_head"))

    joined = rows.join(F.broadcast(bounds), "_pid", "left")
    return (joined.withColumn(prev, F.when(F.col("_first"), F.col("_prev_tail")).otherwise(F.col(prev)))
            .withColumn(nxt, F.when(F.col("_last"), F.col("_next_head")).otherwise(F.col(nxt)))
            .drop("_pid", "_first", "_last", "_prev_tail", "_next_head"))


def local_peaks(df: DataFrame, time_col: str = "DateTime", value: str = "kWh",
                partitions: int | None = None) -> DataFrame:
    """WN3: previous/next reading by time and 'Peak' when strictly above both
    (a missing neighbour compares as unknown, so 'Normal').

    Rows equal in (time, value) are interchangeable for the result, so a row id is the
    last ordering key: it lets the range partitioner split even a run of identical
    readings (one hot key) across tasks."""
    base = df.select(time_col, value).withColumn("_tb", F.monotonically_increasing_id())
    out = global_lag_lead(base, [time_col, value, "_tb"], value, "prev_kwh", "next_kwh", partitions).drop("_tb")
    peak = (F.col(value) > F.col("prev_kwh")) & (F.col(value) > F.col("next_kwh"))
    return out.withColumn("consumption_type", F.when(F.coalesce(peak, F.lit(False)), "Peak").otherwise("Normal"))
