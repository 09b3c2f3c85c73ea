"""Session construction and shared-folder helpers.

Cluster rule: scratch output (round trips, checkpoints, upsert staging) goes under
the shared folder named by ``spark.checkpoint.dir``.  We read that setting from the
session and only invent a local one when it is unset (local tests).
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every voltframe job relies on: UTC wall clock (readings are UTC), ANSI
# arithmetic (bad casts raise unless try_* is used), AQE for runtime re-planning:
# coalesced partitions, runtime broadcast of small sides (a size check done on real
# shuffle statistics, never on estimates), and skew-join splitting for hot keys.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # no broadcast from estimated plan sizes: only explicit broadcasts of measured or
    # fixed-size sides, and AQE's runtime broadcast from measured shuffle sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # what a Python worker is given at once is bounded in bytes, however long the texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": "8MB",
    # JSON with a repeated name is JSON: the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of garbage-collected DataFrames are removed by Spark itself
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "voltframe",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the voltframe defaults applied.  Without ``master`` and
    ``shuffle_partitions``, what spark-submit or the cluster's configuration says holds."""
    builder = SparkSession.builder.appName(app)
    conf = dict(SESSION_DEFAULTS)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def cluster_settings(total_cores: int, input_bytes: float, shuffle_ratio: float = 0.3,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Sizing for a cluster run (apply with ``get_spark(extra=...)``).

    Initial shuffle partitions are sized so a reduce task reads ~256 MB of the expected
    shuffle volume (``input_bytes * shuffle_ratio``; projections and map-side combine
    shrink most shuffles well below the input), at least 2 per core; AQE
    then coalesces small partitions and splits skewed ones.  Scan splits of 256 MB keep
    file tasks large enough to amortize scheduling on 100 TB."""
    import math
    want = math.ceil(input_bytes * shuffle_ratio / target_partition_bytes)
    partitions = max(2 * total_cores, want)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    }


def apply_session_defaults(spark: SparkSession) -> None:
    """Apply the SQL-level defaults to a session we did not build (driver-owned)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a foreign session: leave it
                pass
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``.  Only a local session without it (tests) gets a
    private folder; on a cluster the executors could not see one, so it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            root = None
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="voltframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.  What is still there when the
    process ends in good order is removed; a lifecycle rule is for processes that don't."""
    path = f"{checkpoint_root(spark)}/voltframe/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_scratch)
    _SCRATCH.append(path)
    return path


def _drop_scratch() -> None:
    with contextlib.suppress(Exception):    # at the end of a process the JVM may be gone already
        spark = SparkSession.getActiveSession()
        for path in _SCRATCH if spark is not None else ():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
