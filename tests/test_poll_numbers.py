"""Poll numbers in one pass are those of the looped polls."""

import datetime as dt

from pyspark.sql import functions as F

from docflow.streaming import incremental as W


def events(spark):
    start = dt.datetime(2024, 5, 1)
    kinds = ["view"] * 7 + ["buy", None, "x"]
    rows = [(i, kinds[i % 10], start + dt.timedelta(seconds=i * 37 % 300)) for i in range(400)]
    return spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz")


def test_poll_numbers_are_those_of_the_loop(spark, scratch):
    ev, order = events(spark), [F.col("ts").desc(), F.col("event_id").desc()]
    got = {r.event_id: r.poll for r in W.poll_numbers(ev, "event_type", order, 60).collect()}
    known = ev.filter("event_type is not null")
    W.drain(lambda: W.process_new(known, "event_id", lambda b: b, f"{scratch}/out", f"{scratch}/ledger", quota=("event_type", order, 60)))
    looped = {r.event_id: r.batch_id for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert len(got) == 400 and max(looped.values()) > 1
    assert {k: got[k] for k in looped} == looped


def test_stream_quota_keeps_its_quota(spark, scratch, monkeypatch):
    monkeypatch.setattr(W, "POLL_QUOTA", 3)
    events(spark).write.parquet(f"{scratch}/events.parquet")
    got = W.stream_quota(spark, scratch).collect()
    sizes = [(r.event_type, r.poll) for r in got]
    assert len(got) == 400 and max(sizes.count(x) for x in set(sizes)) == 3
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    want = {r.event_id: r.poll for r in W.poll_numbers(events(spark), "event_type", order, 3).collect()}
    assert {r.event_id: r.poll for r in got} == want
