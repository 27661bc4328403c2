"""Table writers (K1-K5, K9, K10) and the newest-version compaction (K6).

Every stage hands over through a Parquet table on shared storage, not
through log files.  Appends are safe to repeat when a ``batch_id`` is given
(dynamic partition overwrite of that batch only).
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.text import render_html
from docflow.operators.latest import latest_version


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write.  Only a missing
    or still empty path counts as that; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def next_batch(spark: SparkSession, ledger: str, stage: str, out: DataFrame | None = None) -> int:
    """The number of a stage's next run: one more than that of its last
    committed ledger lines.  A run that died before its ledger lines is
    repeated under the same number and replaces what it had written.  Where
    the stage's results ``out`` are further on than that (its ledger was lost
    or is another one), numbers go on after theirs, so nothing is replaced."""
    last = lambda df: df.agg(F.max("batch_id")).first()[0]
    led = read_if_exists(spark, ledger)
    number = -1 if led is None else last(led.filter(F.col("stage") == stage))
    number = 0 if number is None else number + 1
    written = None if out is None else last(out)
    return number if written is None or written <= number else written + 1


def _write(df: DataFrame, path: str, partition_by=(), batch_id: int | None = None):
    """Every table has one layout, ``.../batch_id=N``, whoever writes it: runs
    and polls pass their number (a repeat replaces its own rows), a single
    write without one gets a new time-based number."""
    if batch_id is None:
        batch_id = time.time_ns() // 1000
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, "batch_id").parquet(path))


def write_extracted(df: DataFrame, path: str, batch_id: int | None = None):
    """K1: extracted text + meta (content/link counts, keyword flag, mtime),
    partitioned by region."""
    _write(df, path, ["region"], batch_id)


def write_translated(df: DataFrame, path: str, text: str = "translated", batch_id: int | None = None):
    """K2: translated text and its rendered HTML, partitioned by target."""
    _write(df.withColumn("html", render_html(text)), path, ["to_lang"], batch_id)


def write_jsonl(df: DataFrame, path: str, mode: str = "append"):
    """K3: one JSON object per line, non-ASCII kept as is."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def append_ledger(df: DataFrame, path: str, stage: str, key: str = "page_path", status: str = "status",
                  extra=(), batch_id: int | None = None):
    """Ledger lines (key, stage, status, processed_at, day, extra...),
    partitioned by stage and day, so a reader that only needs recent lines
    (``read_recent_ledger``) prunes whole folders instead of re-reading a
    ledger that grows forever.  Lines always carry a ``batch_id`` (streams
    and jobs pass theirs), so every writer shares one folder layout and a
    repeated batch replaces its own lines."""
    st = F.col(status).cast("int") if status in df.columns else F.lit(0)
    cols = [F.col(key).alias("page_path"), F.lit(stage).alias("stage"),
            st.alias("status"), F.current_timestamp().alias("processed_at"),
            F.current_date().alias("day"), *[F.col(c) for c in extra]]
    _write(df.select(*cols), path, ["stage", "day"], batch_id)


def append_bucketed_ledger(df: DataFrame, table: str, stage: str, buckets: int = 512, key: str = "page_path",
                           status: str = "status", extra=()):
    """K4 as a catalog table bucketed (and sorted) by item key.

    The anti-join "new items vs ledger" runs on every poll against a ledger
    that only grows.  With the ledger bucketed on the key, that join reads
    the ledger without shuffling it; only the (small) new items are
    shuffled into the ledger's buckets."""
    st = F.col(status).cast("int") if status in df.columns else F.lit(0)
    out = df.select(F.col(key).alias("page_path"), F.lit(stage).alias("stage"), st.alias("status"),
                    F.current_timestamp().alias("processed_at"), *[F.col(c) for c in extra])
    (out.write.mode("append").format("parquet").partitionBy("stage")
     .bucketBy(buckets, "page_path").sortBy("page_path").saveAsTable(table))


def read_recent_ledger(spark: SparkSession, path: str, stage: str, days: int | None = None) -> DataFrame:
    """Ledger lines of one stage, only the last ``days`` days when given
    (partition pruning on stage and day: the other folders are not listed
    into the scan).  Items older than the day window never come back (W2),
    so older lines are not needed for the anti-join."""
    led = spark.read.parquet(path).filter(F.col("stage") == stage)
    if days is not None:
        led = led.filter(F.col("day") >= F.date_sub(F.current_date(), days))
    return led


def hourly_manifest(df: DataFrame, ts: str = "processed_at") -> DataFrame:
    """K5: the output manifest hour of each item (minutes forced to 00)."""
    return df.withColumn("hour", F.date_trunc("hour", F.col(ts)))


def write_hourly_manifest(df: DataFrame, path: str, key: str = "page_path", ts: str = "processed_at",
                          batch_id: int | None = None):
    """K5: items listed under the hour they were written."""
    h = hourly_manifest(df, ts).withColumn("hour", F.date_format("hour", "yyyy-MM-dd-HH-00"))
    _write(h.select(key, "hour"), path, ["hour"], batch_id)


def quarantine(df: DataFrame, path: str, stage: str, key: str, reason, batch_id: int | None = None):
    """K9: rows that failed a stage, with the reason; a replayed batch
    replaces its own lines."""
    r = reason if not isinstance(reason, str) else F.lit(reason)
    _write(df.select(F.col(key).alias("item"), F.lit(stage).alias("stage"), r.alias("reason"),
                     F.current_timestamp().alias("logged_at")), path, ["stage"], batch_id)


def append_history(df: DataFrame, path: str, batch_id: int | None = None):
    """K6/K7: every version goes to the history (nothing is updated)."""
    _write(df, path, (), batch_id)


def compact_latest(spark: SparkSession, history: str, out: str, key: str, ts: str, arrival: str) -> DataFrame:
    """K6: materialise the newest-version table to a *new* path (a path being
    read is never overwritten)."""
    latest = latest_version(spark.read.parquet(history), key, ts, arrival)
    latest.write.mode("errorifexists").parquet(out)
    return spark.read.parquet(out)
