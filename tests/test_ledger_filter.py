"""The anti-join through Bloom filters is the plain anti-join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docflow.operators import ledger_filter as LF

DAY = dt.date(2024, 5, 1)


def lines(spark, n=3000, start=0):
    """Lines of four days; a third of them are one key, some have no key."""
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"page/{i}", DAY + dt.timedelta(days=i % 4), i) for i in range(start, start + n)]
    return spark.createDataFrame(rows, "page string, day date, line long")


def items(spark):
    return spark.createDataFrame([(f"page/{i}", i) for i in range(0, 9000, 2)] + [("hot", -1), ("page/1", -2), ("page/1", -2), (None, -3)], "page string, payload long")


@pytest.mark.parametrize("slots", [16, 1024, 1 << 16])    # 16: the filter says yes to nearly all
def test_equals_the_plain_anti_join(spark, scratch, slots):
    kw = {"slots": slots, "buckets": 16}
    for k in range(3):
        LF.append_lines(lines(spark, 1000, 1000 * k), scratch, k, "page", **kw)
    led, its = lines(spark), items(spark)
    for since in (None, DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=9)):
        held = led if since is None else led.filter(F.col("day") >= F.lit(since))
        want = its.join(held.select("page"), "page", "left_anti")
        got = LF.unprocessed(its, scratch, "page", since, **kw)
        assert got.columns == its.columns
        assert sorted(got.collect(), key=str) == sorted(want.select(its.columns).collect(), key=str)


def test_filter_rules_out_most_other_keys(spark, scratch):
    LF.append_lines(lines(spark), scratch, 0, "page", slots=1024, buckets=16)
    others = spark.range(20_000).select(F.concat(F.lit("new/"), "id").alias("page"))
    assert LF.possible(others, scratch, "page", slots=1024, buckets=16).count() < 200
    known = lines(spark).filter("page is not null").select("page")
    assert LF.possible(known, scratch, "page", slots=1024, buckets=16).count() == known.distinct().count()


def test_a_repeated_batch_replaces_itself_and_a_dead_one_hides_nothing(spark, scratch):
    kw = {"slots": 1024, "buckets": 16}
    for _ in range(2):
        LF.append_lines(lines(spark), scratch, 0, "page", **kw)
    assert LF.read_lines(spark, scratch).count() == 3000
    # the next batch died after its filter: its lines are not there, so its items are still to be done
    LF.append_lines(lines(spark, 1000, 3000), f"{scratch}/dead", 1, "page", **kw)
    spark.read.parquet(f"{scratch}/dead/filters").write.mode("append").partitionBy("day", "batch_id").parquet(f"{scratch}/filters")
    want = items(spark).join(lines(spark).select("page"), "page", "left_anti").count()
    assert LF.unprocessed(items(spark), scratch, "page", **kw).count() == want


def test_reads_only_buckets_that_can_match(spark, scratch):
    kw = {"slots": 1 << 16, "buckets": 16}
    LF.append_lines(lines(spark), scratch, 0, "page", **kw)
    bucket = LF.possible(spark.createDataFrame([("page/1",)], "page string"), scratch, "page", **kw).first().bucket
    plan = LF.read_lines(spark, scratch, DAY, [bucket])._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "bucket" in scan and "day" in scan
    none = LF.unprocessed(spark.createDataFrame([("new/1",)], "page string"), scratch, "page", **kw)
    assert none.count() == 1


def test_no_ledger_leaves_all_items(spark, scratch):
    assert LF.unprocessed(items(spark), f"{scratch}/none", "page").count() == items(spark).count()
    LF.append_lines(lines(spark).limit(0), f"{scratch}/empty", 0, "page")
    assert LF.unprocessed(items(spark), f"{scratch}/empty", "page").count() == items(spark).count()
