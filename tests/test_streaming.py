"""Stream = batch on a multi-file stream, and replay safety."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from docflow.operators import ledger as L
from docflow.operators.latest import first_version, latest_version
from docflow.streaming import incremental as W
from tests.conftest import SF_SMALL


@pytest.fixture()
def event_files(spark, scratch):
    """The sf0.001 events split into 4 files, to be read as a stream."""
    from docflow.session import configure
    configure(spark)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    d = f"{scratch}/events_in"
    bounds = list(ev.selectExpr("percentile(event_id, array(0.25, 0.5, 0.75))").first()[0])
    edges = [None, *bounds, None]
    for i in range(4):
        part = ev
        if edges[i] is not None:
            part = part.filter(F.col("event_id") > edges[i])
        if edges[i + 1] is not None:
            part = part.filter(F.col("event_id") <= edges[i + 1])
        part.coalesce(1).write.parquet(f"{d}/part{i}")     # four consecutive id ranges, all rows
    return d, ev.schema, ev


def _stream(spark, d, schema, n=1):
    return W.file_stream(spark, d + "/*", schema, max_files_per_trigger=n)


def test_stream_latest_equals_batch(spark, scratch, event_files):
    d, schema, ev = event_files
    cols = ["user_id", "event_id", "ts", "event_type"]
    W.upsert_history(_stream(spark, d, schema).select(*cols), f"{scratch}/hist", f"{scratch}/ck")
    hist = spark.read.parquet(f"{scratch}/hist")
    assert hist.select("batch_id").distinct().count() == 4          # one file per micro-batch
    got = W.latest_view(spark, f"{scratch}/hist", "user_id", "ts", "event_id")
    want = latest_version(ev.select(*cols), "user_id", "ts", "event_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_polls_take_each_key_once(spark, scratch, event_files):
    d, schema, ev = event_files
    items = ev.select("user_id", "event_id", "ts")
    out, led = f"{scratch}/out", f"{scratch}/ledger"
    taken = 0
    for k in range(4):                       # the window grows by a file each poll
        window = spark.read.parquet(*[f"{d}/part{i}" for i in range(k + 1)]).select("user_id", "event_id", "ts")
        taken += W.process_new(window, "user_id", lambda b: first_version(b, "user_id", "event_id"), out, led)
    got, want = spark.read.parquet(out).drop("batch_id"), first_version(items, "user_id", "event_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert taken == want.count() == spark.read.parquet(led).count()


def test_stream_hourly_equals_batch(spark, scratch, event_files):
    d, schema, ev = event_files
    counts = W.windowed_counts(_stream(spark, d, schema, 2), "ts", [], "1 hour", "1 hour")
    W.rollup_to_table(counts, f"{scratch}/h", f"{scratch}/ck")
    got = W.rollup_view(spark, f"{scratch}/h", ["window_start"]).select("window_start", "n")
    want = ev.groupBy(F.date_trunc("hour", "ts").alias("window_start")).agg(F.count(F.lit(1)).alias("n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replayed_batch_is_not_doubled(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    W.append_batch(df, f"{scratch}/t", 7)
    W.append_batch(df, f"{scratch}/t", 7)
    W.append_batch(df.limit(1), f"{scratch}/t", 8)
    assert spark.read.parquet(f"{scratch}/t").count() == 3


def test_quota_drains_over_polls(spark, scratch):
    """What the quota leaves over is taken by later polls without new input,
    and any split of the input into files gives the same polls."""
    rows = [(i, "s") for i in range(25)]
    seen = []
    for n, parts in enumerate((1, 5)):
        d, out, led = f"{scratch}/in{n}", f"{scratch}/out{n}", f"{scratch}/led{n}"
        spark.createDataFrame(rows, "id long, site string").repartition(parts).write.parquet(d)
        poll = lambda: W.process_new(spark.read.parquet(d), "id", lambda b: b, out, led, quota=("site", [F.col("id").desc()], 10))  # noqa: B023, E731
        assert [poll(), poll(), poll(), poll()] == [10, 10, 5, 0]
        seen.append(sorted((r["batch_id"], r["id"]) for r in spark.read.parquet(out).collect()))
    assert seen[0] == seen[1] == sorted(((24 - i) // 10, i) for i in range(25))


def test_drain_and_quota_per_site(spark, scratch):
    df = spark.createDataFrame([(i, f"s{i % 2}") for i in range(10)], "id long, site string")
    n = W.drain(lambda: W.process_new(df, "id", lambda b: b, f"{scratch}/out", f"{scratch}/led", quota=("site", ["id"], 2)))
    assert n == 3 and spark.read.parquet(f"{scratch}/out").count() == 10


def test_polls_on_a_clock(spark, scratch):
    import time
    taken = []
    q = W.run_polls(spark, lambda: taken.append(1), f"{scratch}/ck", once=False, interval="1 second")
    try:
        end = time.time() + 60
        while len(taken) < 2 and time.time() < end:
            time.sleep(0.2)
    finally:
        q.stop()
    assert len(taken) >= 2


def test_dedupe_and_day_window(spark, scratch):
    now = dt.datetime.now()
    df = spark.createDataFrame([(1, now), (1, now), (2, now - dt.timedelta(days=30))], "id long, ts timestamp")
    assert W.within_days(df, "ts", 7).count() == 2
    d = f"{scratch}/dd"
    df.coalesce(1).write.parquet(f"{d}/f0")
    s = W.dedupe_stream(W.file_stream(spark, d + "/*", df.schema), "id", "ts", "1 hour")
    W.upsert_history(s, f"{scratch}/hist", f"{scratch}/ck")
    assert spark.read.parquet(f"{scratch}/hist").count() == 2
    assert L.union_all([df, df]).count() == 6


def test_restart_after_failure_repeats_without_duplicates(spark, scratch):
    """A poll dies after writing its output but before its ledger lines; the
    next one has the same number and replaces that output."""
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(30)], "id long, site string")
    flag = f"{scratch}/failed_once"

    def flaky_ledger_write(df, path, batch_id, fmt="parquet", _orig=W.append_batch):
        if path.endswith("/led") and not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("executor lost")
        return _orig(df, path, batch_id, fmt)

    out, led = f"{scratch}/out", f"{scratch}/led"
    W.append_batch, orig = flaky_ledger_write, W.append_batch
    try:
        with pytest.raises(RuntimeError):
            W.process_new(df, "id", lambda b: b, out, led)
        assert spark.read.parquet(out).count() == 30        # output written, ledger not
        assert W.process_new(df, "id", lambda b: b, out, led) == 30
    finally:
        W.append_batch = orig
    res = spark.read.parquet(out)
    assert res.count() == 30 and res.select("id").distinct().count() == 30
    assert spark.read.parquet(led).count() == 30
