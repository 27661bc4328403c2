"""Manifests of a hot day are cut into files of bounded length."""

import datetime as dt

from pyspark.sql import functions as F

from docflow.plans import crawl


def test_no_manifest_holds_a_whole_hot_day(spark, scratch, monkeypatch):
    monkeypatch.setattr(crawl, "MANIFEST_LINES", 50)
    start = dt.datetime(2024, 5, 1)
    rows = [(i, start + dt.timedelta(days=20 if i % 10 else i % 30, seconds=i), "view") for i in range(3000)]
    e = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string")
    sizes = [x.n for x in crawl.event_manifests(e, len(rows)).select(F.size(F.split("value", "\n\n")).alias("n")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 150
    e.write.parquet(f"{scratch}/events.parquet")
    got = crawl.q_manifest_window(spark, scratch).collect()
    last = max(ts.date() for _, ts, _ in rows)
    want = sorted(f"/crawl/us/orig/view/n/{i}.html" for i, ts, _ in rows if i % 3 == 0 and (last - ts.date()).days < 10)
    assert sorted(x.page_path for x in got) == want
