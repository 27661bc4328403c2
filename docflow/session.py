"""Session helpers: one place for the configuration the pipeline relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  They are runtime SQL confs, so
# they can also be applied to a session someone else built (see ``configure``).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet timestamps without zone are read as TIMESTAMP_NTZ (wall-clock
    # values, independent of any zone); streams cast to TIMESTAMP only where a
    # watermark needs it (``streaming.incremental.event_time``).
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Limits per group and top-k are taken in every task before the shuffle up
    # to this many rows (Spark's own bound of 1,000 would shuffle all rows).
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000000",
}


# Settings for a large cluster (hundreds of executors, ~100 TB input).
# Shuffles start wide and AQE coalesces them to ~128 MB partitions, so no
# partition has to fit more than that in memory; skewed partitions (a hot
# site or id) are split at 4x the median.  Scans cut files into 128 MB
# splits (the per-byte regex work favours more, smaller tasks), and the
# vectorized Parquet reader decodes 1,024 rows per batch instead of 4,096:
# rows here are whole web pages and texts (~100 KB), so a default batch
# would hold ~400 MB per reader.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Arrow batches for the pandas steps (translate/score functions, NFKC).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, app: str = "docflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session.  ``master`` only matters for local runs;
    on a cluster leave it ``None`` so spark-submit decides, and pass
    ``cluster=True`` for the large-cluster settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # remove checkpoint files of data that is no longer referenced
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_code()
    ensure_checkpoint_dir(spark)
    return spark


def ship_code() -> None:
    """Send this package's Python functions (pandas UDFs, mapInPandas
    steps) to the Python workers by value, so a worker needs no copy of the
    package on its path.  (On a cluster ``--py-files`` works as well.)"""
    import docflow
    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(docflow)
    except ValueError:  # already registered
        pass


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs to an existing session (idempotent)."""
    ship_code()
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf on a managed cluster
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared, fault-tolerant folder and is
    used as is; without it a session whose master is not local is refused.
    Only a local session (tests) gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="docflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
    except Exception:  # a client session without a driver-side context
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for intermediate tables
    (stream checkpoints, history tables written by tests and examples)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/docflow/{name}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
