"""Quota streams against a plain queue, restarts, and late rows."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from docflow.sinks import commits as C
from docflow.streaming import incremental as W
from docflow.streaming.quota import Pages, run_quota, with_ticks

EVENTS = "id long, site string, ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)
MS = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


class Store(dict):
    exists = lambda self: "m" in self
    get = lambda self: self["m"]
    update = lambda self, v: self.__setitem__("m", v)
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.__delitem__


@pytest.mark.parametrize("newest", [True, False])
def test_pages_are_a_queue_or_a_stack(newest):
    r, pages, meta, plain = random.Random(2), Store(), Store(), []
    for _ in range(400):
        q = Pages(pages, meta, 4)
        if r.random() < 0.5:
            items = [str(r.random()) for _ in range(r.choice([0, 1, 3, 11]))]
            q.add(items)
            plain += items
        else:
            n = r.choice([1, 2, 5, 9])
            want = plain[::-1][:n] if newest else plain[:n]
            plain = plain[:len(plain) - len(want)] if newest else plain[len(want):]
            assert q.take(n, newest) == want
        q.save()
        assert bool(q) == bool(plain) and [x for k in sorted(pages) for x in json.loads(pages[k][0])] == plain


def write(spark, path, rows):
    spark.createDataFrame([(*r, False) if len(r) == 3 else r for r in rows], EVENTS + ", __tick boolean").coalesce(1).write.parquet(path)


def taken(spark, out):
    return {r.id: (r.site, r.poll, (r.polled_ms - MS) // 60_000) for r in spark.read.parquet(out).collect()}


@pytest.mark.parametrize("newest", [True, False])
def test_polls_are_those_of_a_plain_loop_and_a_restart_repeats_nothing(spark, scratch, newest):
    """Four files of ten minutes each, a poll every 15 minutes, two items a
    site and poll; the run ends after two files and goes on with the others."""
    r = random.Random(5)
    files, k = [], 0
    for f in range(4):
        rows = []
        for _ in range(25):
            rows.append((k, r.choice(["a", "a", "b", None]), T0 + dt.timedelta(minutes=10 * f, seconds=r.randint(0, 599))))
            k += 1
        files.append(rows)
    args = dict(site="site", ts="ts", order=["ts", "id"], n=2, gap_ms=15 * 60_000, start_ms=MS, newest=newest, page=3)
    schema = None
    for half in (0, 2):
        for f in (half, half + 1):
            write(spark, f"{scratch}/in/{f}", files[f])
        if half:
            write(spark, f"{scratch}/in/9", [(None, None, dt.datetime(2030, 1, 1), True)])
        schema = schema or with_ticks(spark.read.parquet(f"{scratch}/in/0").drop("__tick").schema)
        run_quota(W.file_stream(spark, f"{scratch}/in/*", schema, max_files_per_trigger=1), f"{scratch}/out", f"{scratch}/ckpt", **args)
        if not half:
            first = taken(spark, f"{scratch}/out")
    rows = spark.read.parquet(f"{scratch}/out").collect()
    assert len(rows) == 100 and len({x.id for x in rows}) == 100
    assert all(taken(spark, f"{scratch}/out")[i] == v for i, v in first.items()) and 0 < len(first) < 50
    # a plain loop: when the watermark (newest time of the files so far) has passed a poll, the site's queue is polled
    queues, polls, due, want = {}, {}, {}, {}
    marks = [max(t for _, _, t in f) for f in files]
    for f in range(5):
        if f < 4:
            for i, s, t in sorted(files[f], key=lambda x: (x[2], x[0])):
                queues.setdefault(s, []).append(i)
        now = (marks[f] - T0).total_seconds() / 60 if f < 4 else 10 ** 6
        for s, q in queues.items():
            if s not in due:
                t = max(0, (marks[f - 1] - T0).total_seconds() / 60 if f else -1, min((x[2] - T0).total_seconds() / 60 for x in files[min(f, 3)] if x[1] == s))
                due[s] = (t // 15 + 1) * 15
            while q and due[s] <= now:
                got = [q.pop() if newest else q.pop(0) for _ in range(min(2, len(q)))]
                for i in got:
                    want[i] = (s, polls.get(s, 0), due[s])
                polls[s] = polls.get(s, 0) + 1
                due[s] += 15
            if not q:
                due.pop(s)
    assert taken(spark, f"{scratch}/out") == want


@pytest.mark.parametrize("deal", [lambda i: i % 3, lambda i: i // 40, lambda i: 0])
def test_counts_and_late_rows_are_the_input(spark, scratch, deal):
    r = random.Random(8)
    rows = [(i, r.choice(["a", "b", None]), None if i % 17 == 0 else T0 + dt.timedelta(hours=r.randint(0, 100))) for i in range(120)]
    groups = {}
    for x in rows:
        groups.setdefault(deal(x[0]), []).append(x)
    for g, part in sorted(groups.items()):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.parquet(f"{scratch}/in/{g}")
    schema = spark.read.parquet(f"{scratch}/in/{min(groups)}").schema
    W.count_with_late(W.file_stream(spark, f"{scratch}/in/*", schema, max_files_per_trigger=1), "ts", ["site"], "1 hour", "1 day", f"{scratch}/out", f"{scratch}/ck")
    newest, late = None, set()
    for _, part in sorted(groups.items()):
        late |= {i for i, _, t in part if t is None or newest and t < newest - dt.timedelta(days=1)}
        newest = max([t for _, _, t in part if t] + ([newest] if newest else []))
    assert {x.id for x in C.read_committed(spark, f"{scratch}/out", "late").collect()} == late
    want = {}
    for i, s, t in rows:
        if i not in late:
            want[s, t.replace(minute=0)] = want.get((s, t.replace(minute=0)), 0) + 1
    got = {(x.site, x.window_start): x.n for x in W.counts_view(spark, f"{scratch}/out", ["site"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert got == want and (len(groups) == 1 or len(late) > 8)


def test_files_by_time_read_the_input_a_fixed_number_of_times(spark, scratch):
    """Twenty files of 200 rows; the time is a counted function."""
    calls = spark.sparkContext.accumulator(0)

    def at(i):
        calls.add(1)
        return None if i % 50 == 0 else T0 + dt.timedelta(seconds=i * 7 % 200, microseconds=i)
    rows = spark.range(200).withColumn("ts", F.udf(at, "timestamp_ntz")("id"))
    W.write_by_time(rows, "ts", f"{scratch}/in", 20)
    assert calls.value <= 5 * 200
    got = [spark.read.parquet(f"{scratch}/in/{k:06d}").collect() for k in range(21)]
    assert sorted(x.id for part in got[:20] for x in part) == [i for i in range(200) if i % 50]
    ends = [(min(x.ts for x in part), max(x.ts for x in part)) for part in got if part]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and sum(map(bool, got)) == 21
    assert [x["__tick"] for x in got[20]] == [True] and not any(x["__tick"] for part in got[:20] for x in part)
    W.write_by_time(rows.filter("id = 3"), "ts", f"{scratch}/one", 3)
    assert [spark.read.parquet(f"{scratch}/one/{k:06d}").count() for k in range(4)] == [1, 0, 0, 1]


def test_few_sites_have_few_stores(spark, scratch, monkeypatch):
    """A batch commits every partition's store: two types do not get 40."""
    rows = [(i, "ab"[i % 2], T0 + dt.timedelta(seconds=i)) for i in range(50)]
    spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz").write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(W, "_run_dir", lambda *_: f"{scratch}/run")
    monkeypatch.setattr(W, "POLL_QUOTA", 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {x.event_id: x.poll for x in W.stream_quota(spark, scratch).collect()}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: (49 - i) // 2 // 10 for i in range(50)}
    assert len([d for d in os.listdir(f"{scratch}/run/ckpt/state/0") if d.isdigit()]) <= 12


def test_empty_events(spark, scratch):
    spark.createDataFrame([], "event_id long, event_type string, ts timestamp_ntz, user_id long").write.parquet(f"{scratch}/events.parquet")
    assert W.stream_quota(spark, scratch).collect() == [] and W.stream_late(spark, scratch).collect() == []
