"""Incremental processing with Structured Streaming.

Two forms, as the work asks.  Counts, de-duplication and histories run over a
file stream with a checkpoint (each file is taken once), with state in Spark's
state store; every ``foreachBatch`` write is keyed by ``batch_id``, so a
replayed batch rewrites its own partition.

Work loops (extract, translate, posts, ``process_new``) are polls: each poll
takes its whole window of input minus the ledger, so lines appended to a
known file are seen, and what a quota leaves over is taken by the next poll,
with or without new input.  A poll writes its results and then its ledger
lines under the number after the ledger's last one; a poll that died before
its ledger lines is repeated under the same number and replaces what it had
written.  A continuous job runs a poll on every tick of a rate stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType, TimestampNTZType

from docflow.operators import ledger as L
from docflow.operators.latest import first_version, latest_version
from docflow.operators.ranking import ranked
from docflow.session import configure, scratch_path


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                max_file_age: str | None = None, latest_first: bool = False) -> DataFrame:
    """New files under ``path`` as a stream.  ``max_files_per_trigger``
    bounds one micro-batch (the original's per-poll quota); ``max_file_age``
    ignores files older than the day window (W2)."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "text":
        r = r.option("wholetext", "true")      # a manifest file is one row
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_file_age:
        r = r.option("maxFileAge", max_file_age)
    if latest_first:
        r = r.option("latestFirst", "true")
    return r.load(path)


def append_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent append: the batch goes to its own ``batch_id`` partition,
    overwritten if the batch is replayed."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").format(fmt).save(path))


def run_batches(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                output_mode: str = "append", once: bool = True, interval: str | None = None):
    """Run ``fn`` for each micro-batch.  ``once``: process what is there now
    and stop (``availableNow``); else poll every ``interval``."""
    w = stream.writeStream.outputMode(output_mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval or "10 seconds")
    q = w.start()
    if once:
        q.awaitTermination()
    return q


def within_days(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Only items of the last ``days`` days (event time)."""
    return df.filter(F.col(ts) >= F.current_timestamp() - F.expr(f"INTERVAL {int(days)} DAYS"))


def run_polls(spark: SparkSession, poll: Callable[[], int], checkpoint: str | None = None, once: bool = True,
              interval: str = "10 seconds"):
    """``once``: one poll, whose number of items is returned.  Else a poll on
    every tick of a clock stream; returns the running query."""
    if once:
        return poll()
    clock = spark.readStream.format("rate").option("rowsPerSecond", "1").load()

    def tick(_rows: DataFrame, _batch_id: int):
        poll()
    return run_batches(clock, tick, checkpoint, once=False, interval=interval)


def drain(poll: Callable[[], int]) -> int:
    """Poll until nothing is left (what an endless loop reaches when its
    input stops); returns the number of polls that took items."""
    n = 0
    while poll():
        n += 1
    return n


def process_new(items: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out_path: str,
                ledger_path: str, quota: tuple[str, list, int] | None = None) -> int:
    """W1 + W3, one poll: of ``items`` (the whole window, whose ``key`` may
    repeat) those the ledger does not hold, at most ``quota`` (site column,
    order, n) per site; ``work`` on them, then results and ledger lines under
    the poll's number.  Returns how many keys were taken; what the quota left
    over comes with the next poll.  A key that fills much of the input is
    split by adaptive execution, which the anti-join allows."""
    from docflow.sinks.tables import next_batch, read_if_exists
    spark = items.sparkSession
    led = read_if_exists(spark, ledger_path)
    number = next_batch(spark, ledger_path, PROCESS)
    todo = items
    if led is not None:
        # lines of this number are of an attempt that did not end
        todo = L.unprocessed(items, led.filter(F.col("batch_id") < number), key)
    if quota:
        site, order, n = quota
        todo = L.site_quota(todo, site, order, n).drop("rank")
    todo = todo.persist()
    try:
        append_batch(work(todo), out_path, number)
        taken = todo.select(key).distinct().withColumn("processed_at", F.current_timestamp()).withColumn("stage", F.lit(PROCESS)).persist()
        n = taken.count()
        if n:
            append_batch(taken, ledger_path, number)
        taken.unpersist()
        return n
    finally:
        todo.unpersist()


PROCESS = "process"


def event_time(df: DataFrame, ts: str) -> tuple[DataFrame, bool]:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is cast (in the
    session zone, UTC here) and the caller casts results back."""
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    return (df.withColumn(ts, F.col(ts).cast("timestamp")) if ntz else df), ntz


def dedupe_stream(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Process-once on record id within the watermark delay."""
    s, ntz = event_time(stream, ts)
    out = s.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return out.withColumn(ts, F.col(ts).cast("timestamp_ntz")) if ntz else out


def upsert_history(stream: DataFrame, history_path: str, checkpoint: str):
    """Append every version to a history table (by batch_id)."""
    return run_batches(stream, lambda b, i: append_batch(b, history_path, i), checkpoint)


def upsert_newest(stream: DataFrame, root: str, checkpoint: str, key: str, ts: str, arrival: str, buckets: int | None = None):
    """The newest-version table kept up by every micro-batch, which
    rewrites only the buckets it touches (``sinks.commits``)."""
    from docflow.sinks.commits import BUCKETS, merge_newest

    def merge(batch: DataFrame, number: int):
        merge_newest(batch, root, number, key, ts, arrival, buckets or BUCKETS)
    return run_batches(stream, merge, checkpoint)


def latest_view(spark: SparkSession, history_path: str, key: str, ts: str, arrival: str, cols=None) -> DataFrame:
    """The newest-version table over the history (K6)."""
    return latest_version(spark.read.parquet(history_path).drop("batch_id"), key, ts, arrival, cols)


def windowed_counts(stream: DataFrame, ts: str, by: list[str], window: str, delay: str) -> DataFrame:
    """Tumbling-window counts with a watermark (state older than the
    watermark is dropped)."""
    s, ntz = event_time(stream, ts)
    start = F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")
    return (s.withWatermark(ts, delay).groupBy(*by, F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*by, start.alias("window_start"), "n"))


def rollup_to_table(counts: DataFrame, path: str, checkpoint: str):
    """Write update-mode window counts: each batch appends the windows it
    changed; the view keeps the last value per window."""
    return run_batches(counts, lambda b, i: append_batch(b, path, i), checkpoint, output_mode="update")


def read_output(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that ``append_batch`` wrote, without its batch numbers; empty
    if no batch had rows."""
    from docflow.sinks.tables import read_if_exists
    t = read_if_exists(spark, path)
    return spark.createDataFrame([], schema) if t is None else t.drop("batch_id")


def rollup_view(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last value of each window that ``rollup_to_table`` wrote."""
    t = spark.read.parquet(path)
    cols = [c for c in t.columns if c not in keys and c != "batch_id"]
    w = t.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_v"))
    return w.select(*keys, *[F.col("_v")[c].alias(c) for c in cols])


# --- the registered stream queries over a driver table --------------------

def _events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None):
    configure(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return file_stream(spark, f"{sf_dir}/events.parquet*", schema, max_files_per_trigger=max_files)


def _any_output(spark: SparkSession, path: str) -> bool:
    from docflow.sinks.tables import read_if_exists
    return read_if_exists(spark, path) is not None


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex}")


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 + K5: hourly counts of the event stream."""
    base = _run_dir(spark, "hourly")
    counts = windowed_counts(_events_stream(spark, sf_dir), "ts", [], "1 hour", "1 hour")
    rollup_to_table(counts, f"{base}/out", f"{base}/ckpt")
    if not _any_output(spark, f"{base}/out"):
        return spark.createDataFrame([], "hour timestamp_ntz, n long")
    v = rollup_view(spark, f"{base}/out", ["window_start"])
    return v.select(F.col("window_start").alias("hour"), "n")


def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per stage and hour."""
    base = _run_dir(spark, "health")
    counts = windowed_counts(_events_stream(spark, sf_dir).withColumnRenamed("event_type", "stage"),
                             "ts", ["stage"], "1 hour", "1 hour")
    rollup_to_table(counts, f"{base}/out", f"{base}/ckpt")
    if not _any_output(spark, f"{base}/out"):
        return spark.createDataFrame([], counts.schema)
    return rollup_view(spark, f"{base}/out", ["stage", "window_start"])


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History appended per batch; newest version per user."""
    base = _run_dir(spark, "latest")
    s = _events_stream(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    upsert_history(s, f"{base}/history", f"{base}/ckpt")
    if not _any_output(spark, f"{base}/history"):
        return spark.createDataFrame([], s.schema)
    return latest_view(spark, f"{base}/history", "user_id", "ts", "event_id")


def stream_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W4: each user id taken once, over three growing windows of the
    event table: a poll drops the ids the ledger holds and keeps the first
    arrival of the rest."""
    base = _run_dir(spark, "first")
    configure(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "ts", "event_type")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    for k in (1, 2, 3):
        window = ev if lo is None else ev.filter(F.col("event_id") <= lo + (hi - lo) * k / 3)
        process_new(window, "user_id", lambda b: first_version(b, "user_id", "event_id"), f"{base}/out", f"{base}/ledger")
    return read_output(spark, f"{base}/out", ev.schema)


#: Events a type may have in one poll of ``stream_quota``, and its polls' distance.
POLL_QUOTA, POLL_GAP_MS = 1900, 10_000


def poll_numbers(items: DataFrame, site: str, order: list, n: int) -> DataFrame:
    """``items`` with the number (``poll``, from 0) of the poll in which
    ``drain`` of polls with the quota (site, order, n) would take each, for all
    rows in one pass: ranks come from sorted ranges, so a hot site is not
    ranked in one task."""
    rows = ranked(items, [F.col(site).asc_nulls_first(), *order])
    first = rows.groupBy(F.col(site).alias("__site")).agg(F.min("rank").alias("__first"))
    return (rows.join(first, F.col(site).eqNullSafe(F.col("__site")))
            .withColumn("poll", F.floor((F.col("rank") - F.col("__first")) / n).cast("long")).drop("rank", "__site", "__first"))


#: Rows a file of the poll stream holds at most, and a task takes of it, on average.
FILE_ROWS, TASK_ROWS = 500_000, 50_000


def write_by_time(rows: DataFrame, ts: str, path: str, files: int) -> None:
    """``rows`` that have a time as ``files`` files of consecutive times, written
    one after another, and a last file with one tick far behind them.

    One pass deals the rows to their files beside ``path``; each is then copied
    in turn, as a file stream takes files by the time they were written."""
    spark = rows.sparkSession
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi = rows.agg(F.min(micros), F.max(micros)).first()
    if lo is not None:
        step = -(-(hi - lo + 1) // files)
        dealt = rows.filter(F.col(ts).isNotNull()).withColumn("__tick", F.lit(False)).withColumn("__file", F.floor((micros - lo) / step).cast("int"))
        dealt.repartition(files, "__file").write.partitionBy("__file").parquet(f"{path}_dealt")
        dealt = spark.read.schema(dealt.schema).parquet(f"{path}_dealt")
        for k in range(files):
            dealt.filter(F.col("__file") == k).drop("__file").coalesce(1).write.parquet(f"{path}/{k:06d}")
    tick = spark.range(1).select(*[F.lit("2999-01-01").cast(f.dataType).alias(f.name) if f.name == ts else
                                   F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], F.lit(True).alias("__tick"))
    tick.coalesce(1).write.parquet(f"{path}/{files:06d}")


def stream_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 + W4: the events as a stream of several files; at most ``POLL_QUOTA``
    events per type and poll are let through, newest first.  The polls start
    after the last event, when a tick has moved the watermark, and timers drain
    the queues; every event comes out once, with the number of its poll."""
    from docflow.streaming.quota import run_quota, with_ticks
    configure(spark)
    base = _run_dir(spark, "quota")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "ts")
    n_events, end, types = ev.agg(F.count(F.lit(1)), F.unix_millis(F.max(F.col("ts").cast("timestamp"))), F.approx_count_distinct("event_type")).first()
    write_by_time(ev, "ts", f"{base}/in", max(3, -(-n_events // FILE_ROWS)))
    # a file is one read task; what is made of its rows is shared out
    stream = file_stream(spark, f"{base}/in/*", with_ticks(ev.schema), max_files_per_trigger=1).repartition(FILE_ROWS // TASK_ROWS)
    run_quota(stream, f"{base}/out", f"{base}/ckpt", site="event_type", ts="ts", order=["ts", "event_id"], n=POLL_QUOTA,
              gap_ms=POLL_GAP_MS, start_ms=(end or 0) + 1, sites=types + 1)
    got = spark.read.schema(T.StructType([*ev.schema, T.StructField("poll", T.LongType())])).parquet(f"{base}/out")
    return got.select("event_id", "event_type", "ts", "poll")


def count_with_late(stream: DataFrame, ts: str, by: list[str], window: str, delay: str, root: str, checkpoint: str):
    """W6/W7 with late rows kept: counts per window of the rows that are not
    more than ``delay`` behind the newest time of the batches before theirs;
    the others, and rows without a time, go to the table ``late`` instead of
    vanishing.  Counts, late rows and the newest time are one commit a batch
    (``sinks.commits``), so a repeated batch replaces its own."""
    from docflow.sinks.commits import is_committed, read_committed, write_version

    def count(batch: DataFrame, number: int):
        spark = batch.sparkSession
        if is_committed(spark, root, number):
            return
        seen = read_committed(spark, root, "newest_time")
        newest = seen.agg(F.max("newest")).first()[0] if seen is not None else None
        fresh = F.col(ts).isNotNull() if newest is None else F.coalesce(F.col(ts) >= F.lit(newest) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        rows = batch.persist()
        try:
            w = F.window(ts, window)
            counts = rows.filter(fresh).groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
            write_version(root, number, {
                "counts": counts.select(*by, F.col("w.start").alias("window_start"), "n"),
                "late": rows.filter(~fresh),
                "newest_time": rows.agg(F.max(ts).alias("newest")).coalesce(1)})
        finally:
            rows.unpersist()
    return run_batches(stream, count, checkpoint)


def counts_view(spark: SparkSession, root: str, by: list[str]) -> DataFrame:
    """The committed counts: (by, window_start, n)."""
    from docflow.sinks.commits import read_committed
    return read_committed(spark, root, "counts").groupBy(*by, "window_start").agg(F.sum("n").alias("n"))


LATE_FILES, LATE_DELAY = 3, "10 days"


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + W6 + W7: the events as files in random time order; per day and
    type those counted and those set aside as late."""
    from docflow.sinks.commits import read_committed
    configure(spark)
    base = _run_dir(spark, "late")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "ts")
    for k in range(LATE_FILES):
        ev.filter(F.pmod(F.col("event_id"), F.lit(LATE_FILES)) == k).coalesce(1).write.parquet(f"{base}/in/{k}")
    stream = file_stream(spark, f"{base}/in/*", ev.schema, max_files_per_trigger=1)
    count_with_late(stream, "ts", ["event_type"], "1 day", LATE_DELAY, f"{base}/out", f"{base}/ckpt")
    late = read_committed(spark, f"{base}/out", "late")
    day = late.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count(F.lit(1)).alias("n_late"))
    on_time = counts_view(spark, f"{base}/out", ["event_type"]).withColumn("day", F.col("window_start").cast("timestamp_ntz"))
    out = on_time.select("event_type", "day", "n", F.lit(0).cast("long").alias("n_late")).unionByName(day.withColumn("n", F.lit(0).cast("long")))
    return out.groupBy("event_type", "day").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))
