"""Commits of several tables, and the newest-version table against one pass over the history."""

import datetime as dt
import os
import random

import pytest

from docflow.operators.latest import latest_version
from docflow.sinks import commits as C
from docflow.streaming import incremental as W

EVENTS = "id long, ts timestamp_ntz, arrival long, value string"


def history(n, seed=1):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    ids = [7] * (n // 3) + [None, None] + [r.randint(0, 60) for _ in range(n - n // 3 - 2)]
    r.shuffle(ids)
    return [(i, start + dt.timedelta(minutes=r.randint(0, 40)), k, f"v{k}") for k, i in enumerate(ids)]


def rows(df):
    return sorted(map(str, df.collect()))


def test_ten_batches_are_the_newest_version(spark, scratch):
    hist = history(400)
    for k in range(10):
        C.merge_newest(spark.createDataFrame(hist[k * 40:(k + 1) * 40], EVENTS), scratch, k, "id", "ts", "arrival", buckets=8)
        want = latest_version(spark.createDataFrame(hist[:(k + 1) * 40], EVENTS), "id", "ts", "arrival")
        assert rows(C.read_newest(spark, scratch).select(want.columns)) == rows(want)
    again = C.merge_newest(spark.createDataFrame([(1, dt.datetime(2030, 1, 1), 999, "late")], EVENTS), scratch, 9, "id", "ts", "arrival", buckets=8)
    assert again == [] and "late" not in str(rows(C.read_newest(spark, scratch)))      # a committed number is done


def test_untouched_buckets_keep_their_files(spark, scratch):
    C.merge_newest(spark.createDataFrame(history(300), EVENTS), scratch, 0, "id", "ts", "arrival", buckets=16)
    before = {f for f in C.read_newest(spark, scratch).inputFiles()}
    touched = C.merge_newest(spark.createDataFrame([(7, dt.datetime(2025, 1, 1), 5000, "new"), (7, dt.datetime(2020, 1, 1), 5001, "old")], EVENTS),
                             scratch, 1, "id", "ts", "arrival", buckets=16)
    after = {f for f in C.read_newest(spark, scratch).inputFiles()}
    assert len(touched) == 1 and len(before) > 8
    assert {f for f in before if f"bucket={touched[0]}/" not in f} == {f for f in after if "version=0" in f}
    assert [r.value for r in C.read_newest(spark, scratch).filter("id = 7").collect()] == ["new"]
    with pytest.raises(ValueError, match="buckets"):
        C.merge_newest(spark.createDataFrame(history(300), EVENTS), scratch, 2, "id", "ts", "arrival", buckets=4)


def test_repeated_rows_and_empty_batches(spark, scratch):
    C.merge_newest(spark.createDataFrame([], EVENTS), scratch, 0, "id", "ts", "arrival")
    assert C.read_newest(spark, scratch) is None and C.next_version(spark, scratch) == 1
    row = (1, dt.datetime(2024, 1, 1), 3, "x")
    C.merge_newest(spark.createDataFrame([row, row], EVENTS), scratch, 1, "id", "ts", "arrival")
    C.merge_newest(spark.createDataFrame([row], EVENTS), scratch, 2, "id", "ts", "arrival")
    assert C.read_newest(spark, scratch).count() == 1


@pytest.mark.parametrize("dies_at", [0, 1, 2])
def test_a_job_killed_between_two_writes_changes_nothing(spark, scratch, monkeypatch, dies_at):
    a = spark.createDataFrame([(1, "a")], "i long, t string")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "i long, t string")
    assert C.read_committed(spark, scratch, "items") is None
    assert C.write_version(scratch, 0, {"items": a, "ledger": b})
    seen = [0]
    real = type(a.write).parquet

    def dying(self, path, *args, **kw):
        if seen[0] == dies_at:
            raise RuntimeError("killed")
        seen[0] += 1
        return real(self, path, *args, **kw)
    monkeypatch.setattr(type(a.write), "parquet", dying)
    with pytest.raises(RuntimeError, match="killed"):
        C.write_version(scratch, 1, {"items": b, "ledger": a})
    monkeypatch.undo()
    assert [r.i for r in C.read_committed(spark, scratch, "items").collect()] == [1]
    assert sorted(r.i for r in C.read_committed(spark, scratch, "ledger").collect()) == [2, 3]
    assert os.path.exists(f"{scratch}/items/version=1") == (dies_at > 0) and C.next_version(spark, scratch) == 1
    assert C.write_version(scratch, 1, {"items": b, "ledger": a})
    assert not C.write_version(scratch, 1, {"items": a})
    assert sorted((r.i, r.version) for r in C.read_committed(spark, scratch, "items").collect()) == [(1, 0), (2, 1), (3, 1)]


def test_stream_of_files_keeps_the_table(spark, scratch):
    hist = history(200, 5)
    for k in range(4):
        spark.createDataFrame(hist[k * 50:(k + 1) * 50], EVENTS).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    schema = spark.read.parquet(f"{scratch}/in").schema
    stream = W.file_stream(spark, f"{scratch}/in", schema, max_files_per_trigger=1)
    W.upsert_newest(stream, f"{scratch}/table", f"{scratch}/ckpt", "id", "ts", "arrival", buckets=8)
    want = latest_version(spark.createDataFrame(hist, EVENTS), "id", "ts", "arrival")
    assert rows(C.read_newest(spark, f"{scratch}/table").select(want.columns)) == rows(want)
    assert C.next_version(spark, f"{scratch}/table") == 4
