"""File sources and sinks on small trees made in a temp folder (S1-S14,
K1-K10, J8)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from docflow.operators.keywords import hits_per_lang, merge_wide, merged_lines, normalise_terms, read_keyword_lists
from docflow.sinks import tables as K
from docflow.sources import files as S
from docflow.sources import manifests as M


def _w(path, data, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode + ("b" if isinstance(data, bytes) else "")) as f:
        f.write(data)


def test_page_tree_scan(spark, scratch):
    root = f"{scratch}/html"
    base = f"{root}/jp/orig/www.a.jp/news/2021/03/05-14-30"
    _w(f"{base}/p1.html", "<p>one</p>")
    _w(f"{base}/p1.lang", "ja\n")
    _w(f"{base}/p1.url", "https://www.a.jp/news/p1\n")
    _w(f"{root}/in/orig/www.b.in/2021/03/05-14-30/p2.html", b"<p>ok\xff</p>")
    _w(f"{root}/zz/orig/www.c/2021/03/05-14-30/p3.html", "<p>unknown region</p>")
    _w(f"{root}/jp/tmp/www.a.jp/news/2021/03/05-14-30/p1.html", "<p>tmp</p>")
    pages = S.scan_pages(spark, root, lenient=True)
    got = {r["region"]: r for r in pages.collect()}
    assert set(got) == {"jp", "in"}
    assert got["in"]["html"] == "<p>ok</p>"
    assert got["jp"]["mtime"] is not None
    only_jp = S.scan_pages(spark, root, region="jp")
    assert only_jp.count() == 1
    anywhere = S.scan_folder(spark, f"{root}/jp")          # any folder: orig and tmp both
    assert anywhere.count() == 2
    # Sidecars joined by path stem
    key = S.page_key(F.col("file_path"))
    lang = S.read_sidecar(spark, root, ".lang", first_line=True)
    url = S.read_sidecar(spark, root, ".url")
    j = S.with_sidecars(only_jp.withColumn("key", key), {"lang": lang, "url": url}).first()
    assert (j["lang"], j["url"]) == ("ja", "https://www.a.jp/news/p1")


def test_filtered_scan(spark, scratch):
    d = f"{scratch}/scan"
    for n in ["a.html", "b.htm", "c", "d.txt", "e?x.html", "faq.html", "sub/f.html"]:
        _w(f"{d}/{n}", "x")
    got = [r["path"].rsplit("/", 1)[-1] for r in S.scan_files(spark, d, ignores=["faq"]).orderBy("path").collect()]
    assert got == ["a.html", "b.htm", "c", "f.html"]
    assert S.scan_files(spark, d, ignores=["faq"], total=2).count() == 2


def test_manifests(spark, scratch):
    d = f"{scratch}/manifests"
    root = "/mnt/html"
    for day in range(1, 10):
        lines = [f"{root}/in/orig/site{day % 2}/p{day}.html", f"{root}/int/orig/siteX/q{day}.html",
                 f"{root}/in/orig/site{day % 2}/p{day}.html", "", "garbage"]
        _w(f"{d}/new-html-files-2024-01-{day:02d}-10.txt", "\n".join(lines) + "\n")
    got = M.recent_pages(spark, d, 7, root, region="in", today=dt.date(2024, 1, 9))
    rows = got.orderBy("ordinal").collect()
    assert {r["file_date"] for r in rows} == {dt.date(2024, 1, x) for x in range(3, 10)}
    assert all(r["region"] == "in" for r in rows)
    assert rows[0]["file_date"] == dt.date(2024, 1, 9)          # newest day first
    assert len(rows) == 14                                       # repeated lines kept
    assert sorted(r["line_no"] for r in rows if r["file_date"] == dt.date(2024, 1, 9)) == [0, 2]
    posts = M.recent_posts(spark, d, "/mnt/html/int")
    assert posts.count() == 9
    out = f"{scratch}/merged"
    assert M.merge_manifests(spark, d, "*.txt", out).count() == 9 * 4
    assert spark.read.text(out).count() == 36


def test_ledger_grammars(spark, scratch):
    p = f"{scratch}/ledger.txt"
    _w(p, "p1 jp 0\np2 jp 4\np3 jp\np4 jp 0 extra\n\n")
    three = {r["page_path"]: r["status"] for r in M.read_ledger(spark, p, "three").collect()}
    assert three == {"p1": 0, "p2": 4}
    first = {r["page_path"]: r["status"] for r in M.read_ledger(spark, p, "first").collect()}
    assert first == {"p1": 0, "p2": 4, "p3": None, "p4": None}
    assert M.read_ledger(spark, p, "line").count() == 4
    from docflow.operators.ledger import ok_items
    assert {r["page_path"] for r in ok_items(M.read_ledger(spark, p, "three"), "page_path").collect()} == {"p1"}


def test_jsonl(spark, scratch):
    p = f"{scratch}/out.jsonl"
    _w(p, json.dumps({"orig": {"file": "html/jp/orig/a.html"}, "ja_translated": {"title": "T"}}) + "\n"
       + json.dumps({"orig": {"file": "b.html"}, "ja_translated": {"title": None}}) + "\nbroken{\n")
    v = S.classified_view(S.read_jsonl(spark, p), "/mnt/share").collect()
    assert [(r["title"], r["link"], r["_corrupt"]) for r in v] == [
        ("T", "/mnt/share/html/jp/orig/a.html", False), (None, "/mnt/share/b.html", False), (None, None, True)]


def test_json_sidecar(spark):
    df = spark.createDataFrame([('{"lang": "en"}\nmore',), ("not json",)], "s string")
    assert [r[0] for r in df.select(S.json_field("s", "lang")).collect()] == ["en", None]


def test_dimension(spark, scratch):
    p = f"{scratch}/classes.tsv"
    _w(p, "id\tname\n0\thealth\n1\teconomy\n")
    assert S.read_dimension(spark, p).count() == 2


def test_sinks(spark, scratch):
    df = spark.createDataFrame([("p1", "jp", "ja", 0, "テキスト"), ("p2", "in", "en", 3, "")],
                               "page_path string, region string, to_lang string, status int, translated string")
    K.write_extracted(df, f"{scratch}/extracted")
    assert spark.read.parquet(f"{scratch}/extracted").filter("region = 'jp'").count() == 1
    K.write_translated(df, f"{scratch}/translated", batch_id=0)
    K.write_translated(df, f"{scratch}/translated", batch_id=0)          # replay: no duplicates
    t = spark.read.parquet(f"{scratch}/translated")
    assert t.count() == 2 and t.filter(F.col("html").contains("<p>テキスト</p>")).count() == 1
    K.write_jsonl(df, f"{scratch}/jsonl")
    line = spark.read.text(f"{scratch}/jsonl").filter(F.col("value").contains("p1")).first()[0]
    assert "テキスト" in line                                           # non-ASCII kept
    K.append_ledger(df, f"{scratch}/ledger", "translate_ja", extra=["region"])
    K.append_ledger(df, f"{scratch}/ledger", "translate_ja", extra=["region"])
    led = spark.read.parquet(f"{scratch}/ledger")
    assert led.count() == 4 and led.select("stage").distinct().first()[0] == "translate_ja"
    K.write_hourly_manifest(led, f"{scratch}/hourly")
    assert spark.read.parquet(f"{scratch}/hourly").count() == 4
    K.quarantine(df.filter("status <> 0"), f"{scratch}/errors", "translate", "page_path", "short output")
    assert spark.read.parquet(f"{scratch}/errors").first()["reason"] == "short output"


def test_history_and_latest(spark, scratch):
    import datetime as d
    from docflow.operators.latest import index_records, newer_than
    v = [("id1", d.datetime(2021, 1, 1), 1, "old"), ("id1", d.datetime(2021, 1, 2), 2, "new"),
         ("id1", d.datetime(2021, 1, 2), 3, "same-ts-later"), ("id2", d.datetime(2021, 1, 1), 4, "only")]
    df = spark.createDataFrame(v, "record_id string, ts timestamp, arrival long, text string")
    K.append_history(df, f"{scratch}/hist", batch_id=0)
    latest = K.compact_latest(spark, f"{scratch}/hist", f"{scratch}/latest", "record_id", "ts", "arrival")
    got = {r["record_id"]: r["text"] for r in latest.collect()}
    assert got == {"id1": "new", "id2": "only"}
    cand = spark.createDataFrame([("id1", d.datetime(2021, 1, 2)), ("id2", d.datetime(2021, 1, 5)),
                                  ("id3", d.datetime(2020, 1, 1))], "record_id string, ts timestamp")
    assert {r[0] for r in newer_than(cand, latest, "record_id", "ts").collect()} == {"id2", "id3"}
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    urls = spark.createDataFrame([("a", "u"), ("b", "u")], "k string, url string")
    texts = spark.createDataFrame([("a", "t"), ("c", "t")], "k string, text string")
    rec, skipped = index_records(items, urls, texts, "k")
    assert [r[0] for r in rec.collect()] == ["a"] and {r[0] for r in skipped.collect()} == {"b", "c"}


def test_keyword_lists(spark, scratch):
    lists = {"ja": ["コロナ", "COVID", "肺炎", "COVID"], "en": ["Corona", "COVID", "Pneumonia", "COVID"],
             "zh": ["电晕", "COVID", "肺炎", "COVID"], "ko": ["코로나", "COVID", "폐렴", "COVID"],
             "fr": ["Corona", "COVID", "Pneumonie", "COVID"], "de": ["Corona.", "COVID", "Pneumonie", "COVID"],
             "sp": ["Corona", "COVID", "Neumonía"]}
    files = {}
    for lang, terms in lists.items():
        files[lang] = f"{scratch}/kw/{lang}.txt"
        _w(files[lang], "\n".join(terms) + "\n")
    long = read_keyword_lists(spark, files)
    wide = merge_wide(long).collect()
    assert len(wide) == 4 and wide[3]["sp"] is None and wide[0]["ja"] == "コロナ"
    lines = [r["line"] for r in merged_lines(merge_wide(long)).orderBy("term_id").collect()]
    assert lines[0].split("\t") == ["コロナ", "Corona", "电晕", "코로나", "Corona", "Corona.", "Corona"]
    docs = spark.createDataFrame([(1, "新型コロナと肺炎"), (2, "nothing")], "doc_id long, text string")
    h = {r["doc_id"]: r for r in hits_per_lang(docs, "text", long).collect()}
    assert h[1]["hits_ja"] == 2 and h[1]["hits_zh"] == 1 and h[2]["hits_ja"] == 0
    pairs = normalise_terms(long, "ja")
    assert ("en", "ja", "Corona", "コロナ") in pairs and ("es", "ja", "Neumonía", "肺炎") in pairs


def test_recent_ledger_prunes_partitions(spark, scratch):
    df = spark.createDataFrame([("p1", 0), ("p2", 4)], "page_path string, status int")
    K.append_ledger(df, f"{scratch}/led", "extract")
    K.append_ledger(df, f"{scratch}/led", "translate_ja")
    led = K.read_recent_ledger(spark, f"{scratch}/led", "extract", days=7)
    assert led.count() == 2
    plan = led._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "stage" in plan and "day" in plan


def test_keyword_classes(spark):
    from docflow.operators.keywords import keyword_classes
    terms = spark.createDataFrame([("health", "感染"), ("health", "PCR"), ("economy", "経済"), ("empty", "")],
                                  "class string, term string")
    docs = spark.createDataFrame([(1, "PCR検査と経済"), (2, "感染"), (3, "none")], "id long, text string")
    got = {r["id"]: r["keyword_classes"] for r in keyword_classes(docs, "text", terms).collect()}
    assert got == {1: ["economy", "health"], 2: ["health"], 3: []}


def test_bucketed_ledger_is_not_shuffled(spark, scratch):
    from docflow.operators.ledger import unprocessed
    name = "ledger_bucketed_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for a ledger far too big to broadcast
    try:
        done = spark.createDataFrame([(f"/p/{i}",) for i in range(100)], "page_path string")
        K.append_bucketed_ledger(done, name, "extract", buckets=8)
        led = spark.table(name).filter(F.col("stage") == "extract")
        items = spark.createDataFrame([(f"/p/{i}",) for i in range(90, 120)], "page_path string")
        todo = unprocessed(items, led, "page_path")
        plan = todo._jdf.queryExecution().executedPlan().toString()     # before running: one plan
        assert plan.count("Exchange hashpartitioning") == 1      # the new items only; the ledger is not moved
        assert "Bucketed: true" in plan
        assert sorted(r[0] for r in todo.collect()) == sorted(f"/p/{i}" for i in range(100, 120))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_small_helpers(spark, scratch):
    from docflow.operators import ledger as L
    from docflow.operators.keywords import any_term, read_keyword_lists
    from docflow.operators.routing import route_table
    p = f"{scratch}/ledger.txt"
    _w(p, "p1 jp 0\np2 jp 4\np3 jp\n")
    both = M.read_ledgers(spark, {"translate_ja": (p, "three"), "extract": (p, "line")})
    assert {(r["stage"], r["page_path"]) for r in both.collect()} >= {("translate_ja", "p1"), ("extract", "p3 jp")}
    assert both.count() == 5
    assert route_table(spark).count() == 24
    df = spark.createDataFrame([(1,), (3,), (2,)], "n long")
    assert [r[0] for r in L.newest_first(df, ["n"]).collect()] == [3, 2, 1]
    assert {tuple(r) for r in L.status_totals(M.read_ledger(spark, p, "three"), ["status"]).collect()} == {(0, 1), (4, 1)}
    items = spark.createDataFrame([("p1", "jp"), ("p9", "jp"), ("p8", "in")], "page_path string, region string")
    assert {tuple(r) for r in L.backlog(items, M.read_ledger(spark, p, "first"), "page_path", ["region"]).collect()} \
        == {("jp", 1), ("in", 1)}
    kw = {"ja": f"{scratch}/kw/ja.txt", "en": f"{scratch}/kw/en.txt"}
    _w(kw["ja"], "コロナ\n肺炎\n")
    _w(kw["en"], "Corona\nPneumonia\n")
    docs = spark.createDataFrame([(1, "Pneumonia"), (2, "肺炎"), (3, "x")], "id long, text string")
    got = {r["id"]: r["keyword_flag"] for r in any_term(docs, "text", read_keyword_lists(spark, kw), "en").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_odd_file_names_keep_their_plain_path(spark, scratch):
    names = ["?page=3.html", "a b.html", "100%.html", "x+y.html", "記事.html", "%41.html"]
    folder = f"{scratch}/jp/orig/www.a.jp/n/2024/01/09-10-00"
    os.makedirs(folder)
    for n in names:
        with open(f"{folder}/{n}", "w") as f:
            f.write("<p>x</p>")
        with open(f"{folder}/{n[:-5]}.url", "w") as f:
            f.write("https://u\n")
    want = sorted(f"{folder}/{n}" for n in names)
    for lenient in (False, True):
        assert sorted(r["file_path"] for r in S.scan_pages(spark, scratch, lenient=lenient).collect()) == want
    assert sorted(r["file_path"] for r in S.scan_folder(spark, scratch).collect()) == want
    pages = S.scan_pages(spark, scratch).withColumn("key", S.page_key("file_path"))
    assert S.with_sidecars(pages, {"url": S.read_sidecar(spark, scratch, ".url")}).filter("url = 'https://u'").count() == len(names)
    df = spark.createDataFrame([("hdfs://h:9000/a/b%20c",), ("s3a://bucket/a+b",), ("file:///a",), ("/plain",)], "p string")
    assert [r[0] for r in df.select(S.plain_path(F.col("p"))).collect()] == ["/a/b c", "/a+b", "/a", "/plain"]


def test_unreadable_file_fails_the_task(spark, scratch):
    df = spark.createDataFrame([(scratch,)], "page_path string")          # a folder: there, but not a file
    with pytest.raises(Exception, match="IsADirectoryError|Is a directory"):
        S.read_named_files(df).collect()


def test_lines_without_status_stay_processed(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "page_path string")
    led = spark.createDataFrame([("a", None), ("b", 3)], "page_path string, status int")
    from docflow.operators import ledger as L
    assert sorted(r[0] for r in L.unprocessed(items, led, "page_path", retry_status={3}).collect()) == ["b", "c"]


def test_read_if_exists(spark, scratch):
    from docflow.sinks.tables import next_batch, read_if_exists
    assert read_if_exists(spark, f"{scratch}/none") is None and next_batch(spark, f"{scratch}/none", "s") == 0
    open(f"{scratch}/bad", "w").write("not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, f"{scratch}/bad").count()
