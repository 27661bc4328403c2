"""Properties of the ledger, quota, limit, translation and join operators
(SURVEY §5 d), on the driver tables and small fixtures."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docflow.operators import ledger as L
from docflow.operators.joins import checked_broadcast, skew_join
from docflow.operators.latest import first_version, latest_version
from docflow.operators.routing import text_status
from docflow.operators.translate import dictionary_translator, translate_items
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet")


def test_quota_at_most_n_per_site(spark, docs):
    q = L.site_quota(docs.select("doc_id", "source"), "source", [F.col("doc_id").desc()], 7)
    per = q.groupBy("source").count().collect()
    assert max(r["count"] for r in per) <= 7
    # the kept ones are the newest: every dropped doc is older than every kept doc of its source
    kept_min = {r["source"]: r["m"] for r in q.groupBy("source").agg(F.min("doc_id").alias("m")).collect()}
    dropped = docs.join(q.select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.max("doc_id").alias("m"))
    assert all(r["m"] < kept_min[r["source"]] for r in dropped.collect())


def test_quota_plan_limits_before_shuffle(spark, docs):
    q = L.site_quota(docs.select("doc_id", "source"), "source", [F.col("doc_id").desc()], 7)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ready_set_disjoint_from_done(spark, docs):
    import __spark_entry__ as E
    ready = E.queries()["ready_set"](spark, SF_CHECK)
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    assert ready.join(lab, "doc_id").count() == 0
    ids = [r[0] for r in ready.collect()]
    assert ids == sorted(ids, reverse=True)


def test_unprocessed_and_retry(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    led = spark.createDataFrame([("a", 0), ("b", 3)], "k string, status int")
    assert {r[0] for r in L.unprocessed(items, led, "k").collect()} == {"c"}
    assert {r[0] for r in L.unprocessed(items, led, "k", retry_status={3}).collect()} == {"b", "c"}


def test_head_tail_small_input_no_repeats(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "n")
    got = [r[0] for r in L.head_tail(df, ["n"], 30).collect()]
    assert sorted(got) == list(range(50))
    got2 = sorted(r[0] for r in L.head_tail(spark.range(0, 100).withColumnRenamed("id", "n"), ["n"], 10).collect())
    assert got2 == list(range(10)) + list(range(90, 100))


def test_latest_one_row_per_id_and_tie_rule(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    lv = latest_version(ev.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")
    assert lv.count() == lv.select("user_id").distinct().count() == ev.select("user_id").distinct().count()
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 10, t, "first"), (1, 11, t, "second")], "id long, arr long, ts timestamp, v string")
    assert latest_version(df, "id", "ts", "arr").first()["v"] == "first"
    assert first_version(df, "id", "arr").first()["v"] == "first"


def test_latest_plan_is_partial_aggregate(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    lv = latest_version(ev.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")
    plan = lv._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "partial_max(_order" in plan
    df = spark.createDataFrame([(1, 1, None, "a"), (None, 2, None, "b"), (None, 1, None, "c")], "id long, arr long, ts timestamp, v string")
    assert sorted(r["v"] for r in latest_version(df, "id", "ts", "arr").collect()) == ["a", "c"]      # null times and ids keep their row


def test_status_codes(spark):
    rows = [(1, "fr", "corona ici"), (2, "xx", "corona"), (3, "fr", ""), (4, "fr", "rien"),
            (5, "fr", "\n".join(["corona"] * 501)), (6, "ja", "\n".join(["corona"] * 501)), (7, "fr", "c"),
            (8, "zh-cn", "corona")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    st = {r["doc_id"]: r["status"] for r in text_status(df, ["ja"], ["corona", "c"]).collect()}
    assert st == {1: 0, 2: 9, 3: 4, 4: 1, 5: 7, 6: 0, 7: 3, 8: 0}


def test_translate_dictionary_and_memory(spark):
    rows = [(1, "fr", "ja", 0, "Corona ici\nligne deux"), (2, "ja", "ja", 0, "コロナ"),
            (3, "fr", "ja", 9, "x"), (4, "fr", "ja", 0, "Corona ici")]
    items = spark.createDataFrame(rows, "doc_id long, src_lang string, to_lang string, status int, text string")
    fn = dictionary_translator([("fr", "ja", "Corona", "コロナ")])
    mem = spark.createDataFrame([("fr", "ja", "Corona ici\nligne deux", "MEMORY")],
                                "from_lang string, to_lang string, part string, translated string")
    later = mem.selectExpr("from_lang", "to_lang", "part", "'LATER' AS translated", "2 AS batch_id")
    for memory in (mem, mem.selectExpr("*", "1 AS batch_id").unionByName(later)):       # the first translation written counts
        out = {r["doc_id"]: r for r in translate_items(items, "doc_id", translate_fn=fn, memory=memory).collect()}
        assert out[1]["translated"] == "MEMORY" and out[1]["n_parts"] == 1
        assert out[2]["translated"] == "コロナ" and out[2]["status"] == 0
        assert out[3]["status"] == 9 and out[3]["translated"] is None
        assert out[4]["translated"] == "コロナ ici"


def test_each_distinct_part_translated_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(b: pd.DataFrame) -> pd.Series:
        calls.add(len(b))
        return b["part"].str.upper()
    rows = [(i, "fr", "ja", 0, "même texte") for i in range(40)] + [(99, "fr", "ja", 0, "autre")]
    items = spark.createDataFrame(rows, "doc_id long, src_lang string, to_lang string, status int, text string")
    out = translate_items(items, "doc_id", translate_fn=fn)
    assert out.filter(F.col("translated") == "MÊME TEXTE").count() == 40
    assert calls.value == 2


def test_hot_key_join_is_split(spark):
    """Adaptive execution deals a hot key's rows out over several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).checkpoint()
        out = skew_join(left, right, "k")
        assert out.filter("k = 0 and n = 40001").count() == 40001
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_checked_broadcast_measures_bytes(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert checked_broadcast(df, 2000) is not None and checked_broadcast(df, 500) is None


def test_translate_posts(spark):
    from docflow.operators.translate import translate_posts
    rows = [(1, "\n\nCorona #tag https://x.y/z\n", "fr"), (2, "", "fr"), (3, "hi", "xx"), (4, "\nコロナ", "ja")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    fn = dictionary_translator([("fr", "ja", "Corona", "コロナ")])
    out = {r["id"]: r for r in translate_posts(df, "id", "text", "lang", "ja", fn).collect()}
    assert out[1]["translated"] == "\n\nコロナ  ｟#tag  ｠  ｟https://x.y/z ｠ \n"
    assert out[2]["status"] == 1 and out[3]["status"] == 9
    assert out[4]["translated"] == "\nコロナ"


def test_stage_health_and_unscored(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 12)
    led = spark.createDataFrame([("extract", t, 0), ("extract", t, 4), ("translate", t - dt.timedelta(hours=5), 0)],
                                "stage string, processed_at timestamp, status int")
    h = {r["stage"]: r for r in L.stage_health(led).collect()}
    assert (h["extract"]["n"], h["extract"]["n_failed"], h["extract"]["stale"]) == (2, 1, False)
    assert h["translate"]["stale"] is True
    rec = spark.createDataFrame([("/r/a",), ("/r/b",), (None,)], "link string")
    done = spark.createDataFrame([("/r/a",)], "page_path string")
    assert [r[0] for r in L.unscored_records(rec, done).collect()] == ["/r/b"]


def test_page_status_exists_and_sidecars(spark):
    from docflow.operators.pages import page_features
    from docflow.operators.routing import page_status
    from docflow.sources.files import all_present
    pages = spark.createDataFrame([(1, "http://a.b/en/1", '<html lang="en"><p>action</p></html>'),
                                   (2, "http://a.b/en/2", '<html lang="en"><p>action</p></html>')],
                                  "page_id long, url string, html string")
    done = spark.createDataFrame([(2,)], "page_id long")
    st = {r["page_id"]: r["status"] for r in page_status(page_features(pages), "ja", ["tion"], done=done).collect()}
    assert st == {1: 0, 2: 5}
    df = spark.createDataFrame([("m", "t", "b"), ("m", None, "b")], "meta string, title string, block string")
    assert [r[0] for r in df.select(all_present("meta", "title", "block")).collect()] == [True, False]


def test_two_level_top_k_and_quota(spark, docs):
    d = docs.select("doc_id", "source").repartition(40)
    want = [r[0] for r in d.orderBy(F.col("doc_id").desc()).limit(25).collect()]
    got = [r[0] for r in L.top_k(d, [F.col("doc_id").desc()], 25, buckets=6).collect()]
    assert got == want
    one = L.site_quota(d, "source", [F.col("doc_id").desc()], 7, buckets=1)
    two = L.site_quota(d, "source", [F.col("doc_id").desc()], 7, buckets=6)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    ht = L.head_tail(d, ["doc_id"], 30, buckets=5)
    assert ht.count() == 60


def test_post_text_first_paragraph(spark):
    from docflow.operators.translate import post_text
    df = spark.createDataFrame([("<p>hello <b>#tag</b></p><p>two</p>",), ("<p></p><p>late</p>",), ("<div>x</div>",)],
                               "html string")
    assert [r[0] for r in df.select(post_text("html")).collect()] == ["hello #tag", "", ""]


def test_failed_part_is_empty_and_memory_grows(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def fn(b: pd.DataFrame) -> pd.Series:
        calls.add(len(b))
        if (b["part"] == "boom").any():
            raise RuntimeError("service error")
        return b["part"].str.upper()
    rows = [(1, "fr", "ja", 0, "boom"), (2, "fr", "ja", 0, "fine"), (3, "fr", "ja", 0, "boom\n" + "x" * 300)]
    items = spark.createDataFrame(rows, "doc_id long, src_lang string, to_lang string, status int, text string")
    mem = str(tmp_path / "tm")
    out = {r["doc_id"]: r for r in translate_items(items, "doc_id", translate_fn=fn, memory_out=mem).collect()}
    assert out[1]["translated"] == "" and out[1]["status"] == 3          # failed part -> '' -> too short
    assert out[2]["translated"] == "FINE"
    assert out[3]["translated"] == "\n" + "X" * 300                       # the failed part is empty, the other kept
    first = calls.value
    memory = spark.read.parquet(mem)
    assert {r["part"] for r in memory.collect()} == {"fine", "x" * 300}
    out2 = {r["doc_id"]: r for r in translate_items(items, "doc_id", translate_fn=fn, memory=memory).collect()}
    assert out2[2]["translated"] == "FINE"
    assert calls.value - first <= 2                                       # only the failing part is asked again


def test_ready_set_on_path_lists(spark):
    """J2 as the classifier runs it: translated-to-ja ok, translated-to-en
    ok, block XML done, not yet classified, matched on the feature key
    (region/site/path/name, stage folder and suffix left out)."""
    from docflow.functions.paths import feature_key
    root = "/share/html"
    p = lambda stage, name, ext: f"{root}/jp/{stage}/www.a.jp/news/2024/01/09-10-00/{name}.{ext}"
    ja = [p("ja_translated", n, "html") for n in ("a", "b", "c", "d")]
    en = [p("en_translated", n, "html") for n in ("a", "b", "c")]
    xml = [p("tmp", n, "block") for n in ("a", "b", "c", "d")]
    done = [p("ja_translated", "b", "html")]

    def frame(paths):
        df = spark.createDataFrame([(x,) for x in paths], "path string")
        return df.withColumn("key", feature_key("path", root))
    ready = L.ready_set(frame(ja), frame(en), frame(xml), frame(done), "key", order=[F.col("path").desc()])
    assert [r["path"].rsplit("/", 1)[-1] for r in ready.collect()] == ["c.html", "a.html"]
