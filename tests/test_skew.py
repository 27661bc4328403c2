"""The skew paths give exactly the plain results (random data with a hot key)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.operators import ledger as L

CFG = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.lists(st.integers(0, 30), min_size=1, max_size=300)


@CFG
@given(keys=KEYS, n=st.integers(1, 8), buckets=st.integers(2, 7))
def test_two_level_limits_equal_one_level(spark, keys, n, buckets):
    df = spark.createDataFrame([(k % 5, i) for i, k in enumerate(keys)], "site long, id long").repartition(9)
    one = sorted(tuple(r) for r in L.site_quota(df, "site", [F.col("id").desc()], n, buckets=1).collect())
    two = sorted(tuple(r) for r in L.site_quota(df, "site", [F.col("id").desc()], n, buckets=buckets).collect())
    assert one == two
    t1 = [r["id"] for r in L.top_k(df, [F.col("id").desc()], n, buckets=1).collect()]
    t2 = [r["id"] for r in L.top_k(df, [F.col("id").desc()], n, buckets=buckets).collect()]
    assert t1 == t2


def test_top_k_beyond_a_thousand_is_limited_before_the_shuffle(spark):
    df = spark.range(0, 20_000, 1, 4)
    for k in (1000, 1001, 5000):
        top = L.top_k(df, [F.col("id").desc()], k)
        assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
        assert [r["id"] for r in top.collect()] == list(range(19_999, 19_999 - k, -1))
