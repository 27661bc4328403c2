"""The physical plans keep the shapes the design relies on (README, PLANS.md)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from docflow.operators import ledger as L
from tests.conftest import SF_CHECK


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_page_features_need_no_hash_shuffle(spark):
    for name in ("block_counts", "page_headings", "link_flags", "extracted", "chunks", "text_flags"):
        plan = _plan(E.queries()[name](spark, SF_CHECK))
        assert "hashpartitioning" not in plan, name


def test_flagship_reads_only_needed_columns_and_aggregates_partially(spark):
    df = E.queries()["page_status"](spark, SF_CHECK)
    text = _formatted(df)
    assert re.search(r"ReadSchema: struct<page_id:bigint,url:string,html:string>", text)
    assert "partial_count" in _plan(df)


def test_filter_on_features_stays_above_the_generate(spark):
    text = _formatted(E.queries()["index_pages"](spark, SF_CHECK))
    # the status filter is applied after the features were generated once
    tree = text.split("\n\n")[0]
    assert tree.index("Filter") < tree.index("Generate")


def test_two_level_quota_limits_before_each_shuffle(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "source")
    plan = _plan(L.site_quota(d, "source", [F.col("doc_id").desc()], 5, buckets=4))
    assert plan.count("WindowGroupLimit") == 4 and "Partial" in plan
