"""The original's flows end to end on a small crawl tree in a temp folder."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow import flows
from docflow.sources import files as S
from docflow.sources import manifests as M


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _tree(root, man):
    pages = {
        "jp/orig/www.a.jp/news/2024/01/09-10-00/p1.html": "<html><title>新型コロナ</title><p>コロナの情報です</p></html>",
        "us/orig/www.b.com/n/2024/01/08-09-00/p2.html": "<title>News</title><p>COVID update line</p><p>second</p>",
        "us/orig/www.b.com/n/2024/01/09-09-00/p3.html": "<title>Sport</title><p>football</p>",
        "in/orig/site.in/2024/01/09-11-00/p4.html": "<p>corona news</p><ul>" + "<li><a href='/x'>a</a></li>" * 10 + "</ul>",
    }
    for rel, html in pages.items():
        _w(f"{root}/{rel}", html)
        _w(f"{root}/{rel[:-5]}.url", f"https://{rel.split('/')[2]}/{rel.split('/')[-1]}\n")
    paths = [f"{root}/{p}" for p in pages]
    _w(f"{man}/new-html-files-2024-01-08-09.txt", paths[1] + "\n")
    _w(f"{man}/new-html-files-2024-01-09-12.txt", "\n".join([paths[0], paths[2], paths[3], paths[0]]) + "\n")
    return paths


def test_extract_translate_index(spark, scratch):
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    paths = _tree(root, man)
    lines = M.recent_pages(spark, man, 7, root, today=dt.date(2024, 1, 9))
    pages = S.scan_pages(spark, root)
    rec, led = flows.extract_flow(lines, pages)
    got = {r["page_path"]: r for r in rec.collect()}
    assert set(got) == set(paths)
    assert got[paths[0]]["keyword_flag"] and got[paths[1]]["keyword_flag"] and not got[paths[2]]["keyword_flag"]
    assert got[paths[0]]["text"] == "新型コロナ\nコロナの情報です"
    # a second poll with the ledger finds nothing new
    rec2, _ = flows.extract_flow(lines, pages, ledger=led)
    assert rec2.count() == 0

    # retry: an item whose only ledger line says 3 (short output) is taken again when asked
    led3 = spark.createDataFrame([(paths[1], 3), (paths[2], 0)], "page_path string, status int")
    again, _ = flows.translate_flow(rec, led3, "ja", retry_status={3})
    assert {r["page_path"] for r in again.collect()} == {paths[0], paths[1], paths[3]}
    tr, tled = flows.translate_flow(rec, None, "ja")
    st = {r["page_path"]: r for r in tr.collect()}
    assert st[paths[0]]["status"] == 0 and st[paths[0]]["translated"] == got[paths[0]]["text"]   # same language
    assert st[paths[1]]["status"] == 0 and st[paths[1]]["n_parts"] == 1
    assert st[paths[2]]["status"] == 1                                                          # no keyword
    assert st[paths[3]]["status"] == 2                                                          # (1+1)/(1+10+1) < 0.2
    assert tled.count() == 4

    urls = S.read_sidecar(spark, root, ".url").select(F.concat("key", F.lit(".html")).alias("page_path"), "url")
    newest, first, skipped = flows.index_flow(tr.withColumn("arrival", F.lit(1)), urls, root, tz="Asia/Tokyo")
    got = {r["record_id"]: r["record"] for r in newest.collect()}
    assert set(got) == {"jp/www.a.jp/news/p1", "us/www.b.com/n/p2"}
    r = got["jp/www.a.jp/news/p1"]
    assert (r.region, r.domain, r.path, r.url) == ("jp", "www.a.jp", "news", "https://www.a.jp/p1.html")
    assert (r.timestamp.year, r.timestamp.day, r.timestamp.hh, r.timestamp.utc) == (2024, 9, 10, dt.datetime(2024, 1, 9, 1))
    assert first.count() == 2 and skipped.count() == 0
    assert first.filter(F.col("record_id") == "jp/www.a.jp/news/p1").first()["@timestamp"] == dt.datetime(2024, 1, 9, 1)


def test_posts_flow(spark):
    rows = [(f"/t/{i}", i, f"post {i} #tag", "en") for i in range(10)]
    posts = spark.createDataFrame(rows, "post_path string, ordinal long, text string, lang string")
    done = spark.createDataFrame([("/t/0",)], "post_path string")
    out = flows.posts_flow(posts, done, "ja", n=3)
    got = sorted(r["post_path"] for r in out.collect())
    assert got == ["/t/1", "/t/2", "/t/3", "/t/7", "/t/8", "/t/9"]


def test_extract_stream_takes_each_page_once(spark, scratch):
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    paths = _tree(root, man)
    out, led, ck = f"{scratch}/extracted", f"{scratch}/ledger", f"{scratch}/ck"
    flows.extract_stream(spark, man, root, out, led, ck, today=dt.date(2024, 1, 9))
    got = spark.read.parquet(out)
    assert sorted(r["page_path"] for r in got.collect()) == sorted(paths)
    assert got.filter(F.col("region") == "jp").first()["text"] == "新型コロナ\nコロナの情報です"
    # a new manifest naming one old, one new and one missing page: only the
    # new one is extracted; the missing one is recorded with status 4
    new = f"{root}/jp/orig/www.a.jp/news/2024/01/09-13-00/p5.html"
    gone = f"{root}/jp/orig/www.a.jp/news/2024/01/09-13-00/gone.html"
    _w(new, "<p>コロナ 5</p>")
    _w(f"{man}/new-html-files-2024-01-09-13.txt", "\n".join([paths[0], new, gone]) + "\n")
    flows.extract_stream(spark, man, root, out, led, ck, today=dt.date(2024, 1, 9))
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.filter(F.col("page_path") == new).count() == 1
    ledger = spark.read.parquet(led)
    assert ledger.select("page_path").distinct().count() == 6
    assert [r["status"] for r in ledger.filter(F.col("page_path") == gone).collect()] == [4]
    assert spark.read.parquet(f"{led}_errors").count() == 1


def test_read_named_files(spark, scratch):
    p = f"{scratch}/a.html"
    with open(p, "wb") as fh:
        fh.write(b"<p>ok\xff</p>")
    df = spark.createDataFrame([(p,), (f"{scratch}/missing.html",)], "page_path string")
    rows = {r["page_path"]: r for r in S.read_named_files(df).collect()}
    assert rows[p]["html"] == "<p>ok</p>" and rows[p]["mtime_s"] > 0
    assert rows[f"{scratch}/missing.html"]["html"] is None


def test_jobs_end_to_end(spark, scratch):
    from docflow import jobs
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    paths = _tree(root, man)
    t = f"{scratch}/tables"
    a = jobs.parser().parse_args(["extract", "--root", root, "--manifests", man, "--out", f"{t}/extracted",
                                  "--ledger", f"{t}/ledger", "--checkpoint", f"{t}/ck", "--days", "100000"])
    jobs.run_extract(spark, a)
    assert spark.read.parquet(f"{t}/extracted").count() == len(paths)
    a = jobs.parser().parse_args(["translate", "--extracted", f"{t}/extracted", "--ledger", f"{t}/ledger",
                                  "--to", "en", "--out", f"{t}/translated"])
    jobs.run_translate(spark, a)
    tr = spark.read.parquet(f"{t}/translated")
    assert tr.count() == len(paths) and tr.filter("status = 0").count() >= 2
    jobs.run_translate(spark, a)                     # second run: everything is in the ledger
    assert spark.read.parquet(f"{t}/translated").count() == len(paths)
    a = jobs.parser().parse_args(["index", "--translated", f"{t}/translated", "--root", root,
                                  "--history", f"{t}/index", "--run-id", "1"])
    jobs.run_index(spark, a)
    assert spark.read.parquet(f"{t}/index/newest-1").count() >= 2
    a = jobs.parser().parse_args(["health", "--ledger", f"{t}/ledger", "--out", f"{t}/health", "--run-id", "1"])
    jobs.run_health(spark, a)
    h = {r["stage"]: r for r in spark.read.parquet(f"{t}/health/health-1").collect()}
    assert set(h) == {"extract", "translate_en"} and h["extract"]["n"] == len(paths)


def test_classify_flow(spark):
    from docflow.operators.scoring import enrich
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "doc_id long")
    docs = spark.createDataFrame([(1, "en", "a"), (2, "en", ""), (3, None, "c"), (4, "en", "d")],
                                 "doc_id long, lang string, text string")
    first = docs.join(ids([1, 2, 3, 4]), "doc_id", "left_semi")
    steps = [("meta", lambda x: x, F.col("lang").isNotNull()), ("text", lambda x: x, F.length("text") > 0)]
    out = flows.classify_flow(first, ids([1, 2, 3]), ids([1, 2, 3, 4]), ids([4]), "doc_id",
                              lambda ready: enrich(ready, steps))
    assert {r["doc_id"]: r["status"] for r in out.collect()} == {1: 0, 2: 1, 3: 1}


def test_translate_stream_after_extract_stream(spark, scratch):
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    paths = _tree(root, man)
    ext, led, tr = f"{scratch}/extracted", f"{scratch}/ledger", f"{scratch}/translated"
    flows.extract_stream(spark, man, root, ext, led, f"{scratch}/ck_e", today=dt.date(2024, 1, 9))
    flows.translate_stream(spark, ext, tr, led, f"{scratch}/ck_t", "en")
    first = spark.read.parquet(tr)
    assert first.select("page_path").distinct().count() == len(paths)
    new = f"{root}/jp/orig/www.a.jp/news/2024/01/09-13-00/p5.html"
    _w(new, "<p>コロナ 5</p>")
    _w(f"{man}/new-html-files-2024-01-09-13.txt", new + "\n")
    flows.extract_stream(spark, man, root, ext, led, f"{scratch}/ck_e", today=dt.date(2024, 1, 9))
    flows.translate_stream(spark, ext, tr, led, f"{scratch}/ck_t", "en")
    got = spark.read.parquet(tr)
    assert got.count() == len(paths) + 1                       # only the new page was added
    assert got.filter(F.col("page_path") == new).first()["status"] == 0


def test_posts_from_files(spark, scratch):
    root, man = f"{scratch}/twitter/html", f"{scratch}/manifests"
    base = f"{root}/jp/orig/2024/01/09/10-00"
    posts = {"1": ("<p>Corona #tag https://t.co/x</p>", '{"lang": "en"}'),
             "2": ("<p></p><p>late</p>", '{"lang": "en"}'),
             "3": ("<p>hola</p>", '{"lang": "xx"}'),
             "4": ("<p>no sidecar</p>", None)}
    for i, (html, js) in posts.items():
        _w(f"{base}/{i}.html", html)
        if js:
            _w(f"{base}/{i}.json", js + "\n")
    _w(f"{man}/new-twitter-html-files-2024-01-09-10.txt", "\n".join(f"{base}/{i}.html" for i in posts) + "\n")
    lines = M.recent_posts(spark, man, scratch).withColumn(
        "ordinal", F.struct("file_date", "file_name", "line_no"))
    got = flows.read_posts(lines)
    out = {r["post_path"].rsplit("/", 1)[-1]: r for r in flows.posts_flow(got, None, "ja").collect()}
    assert out["1.html"]["status"] == 0 and "｟#tag  ｠" in out["1.html"]["translated"]
    assert out["2.html"]["status"] == 1                   # first <p> is empty
    assert out["3.html"]["status"] == 9 and out["4.html"]["status"] == 9   # unknown / missing language
    idx = flows.index_posts(flows.posts_flow(got, None, "ja").withColumn("arrival", F.lit(1)),
                            f"{scratch}/twitter/html").collect()
    assert [(r["record_id"], r["record"].country, r["record"].timestamp.hh) for r in idx] == [("1", "jp", 10)]
    # the same loop as a job, twice: the second run finds everything in the ledger
    from docflow import jobs
    args = ["posts", "--manifests", man, "--prefix", scratch, "--to", "ja", "--out", f"{scratch}/tr",
            "--ledger", f"{scratch}/led"]
    jobs.run_posts(spark, jobs.parser().parse_args(args))
    jobs.run_posts(spark, jobs.parser().parse_args(args))
    assert spark.read.parquet(f"{scratch}/tr").count() == 4
    # the stream form: a new manifest triggers a run; only the new post is added
    flows.posts_stream(spark, man, scratch, f"{scratch}/tr2", f"{scratch}/led2", f"{scratch}/ck2", "ja")
    assert spark.read.parquet(f"{scratch}/tr2").count() == 4
    _w(f"{base}/5.html", "<p>more #news</p>")
    _w(f"{base}/5.json", '{"lang": "en"}\n')
    _w(f"{man}/new-twitter-html-files-2024-01-09-11.txt", f"{base}/5.html\n")
    flows.posts_stream(spark, man, scratch, f"{scratch}/tr2", f"{scratch}/led2", f"{scratch}/ck2", "ja")
    tr2 = spark.read.parquet(f"{scratch}/tr2")
    assert tr2.count() == 5 and tr2.filter(F.col("post_path").endswith("/5.html")).first()["status"] == 0


def test_extract_stream_polling_trigger(spark, scratch):
    import time
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    paths = _tree(root, man)
    q = flows.extract_stream(spark, man, root, f"{scratch}/ext", f"{scratch}/led", f"{scratch}/ck",
                             today=dt.date(2024, 1, 9), once=False, interval="1 second")
    try:
        end = time.time() + 90
        while not os.path.exists(f"{scratch}/led/stage=extract") and time.time() < end:
            time.sleep(0.2)
    finally:
        q.stop()
    assert spark.read.parquet(f"{scratch}/ext").count() == len(paths)


def test_appended_lines_arrive_and_quota_is_per_region(spark, scratch):
    root, man = f"{scratch}/html", f"{scratch}/manifests"
    name = f"{man}/new-html-files-2024-01-09-12.txt"
    page = lambda region, i: f"{root}/{region}/orig/www.s.com/n/2024/01/09-10-00/p{i}.html"
    for region in ("us", "jp"):
        for i in range(4):
            _w(page(region, i), f"<p>covid {i}</p>")
    _w(name, "\n".join(page(r, i) for r in ("us", "jp") for i in range(3)) + "\n")
    args = (spark, man, root, f"{scratch}/ext", f"{scratch}/led")
    assert flows.extract_stream(*args, quota=3, today=dt.date(2024, 1, 9)) == 6      # one site, two regions: three each
    with open(name, "a") as f:
        f.write(page("us", 3) + "\n")
    assert flows.extract_stream(*args, quota=4, today=dt.date(2024, 1, 9)) == 1      # a line added to a known manifest
    assert flows.extract_stream(*args, quota=4, today=dt.date(2024, 1, 9)) == 0
    tr = (spark, f"{scratch}/ext", f"{scratch}/tr", f"{scratch}/led", None, "ja")
    assert [flows.translate_stream(*tr, quota=2) for _ in range(3)] == [4, 3, 0]     # leftovers come without new input
    assert spark.read.parquet(f"{scratch}/tr").select("page_path").distinct().count() == 7


def test_translate_poll_then_index_on_one_table(spark, scratch):
    """Batch and polling runs share one layout, carry ``arrival``, keep a
    growing memory, use ``.lang`` files and list hourly manifests."""
    from docflow import jobs
    root, man, t = f"{scratch}/html", f"{scratch}/manifests", f"{scratch}/tables"
    paths = _tree(root, man)
    _w(paths[1][:-5] + ".lang", "fr\n")
    flows.extract_stream(spark, man, root, f"{t}/ext", f"{t}/led", today=dt.date(2024, 1, 9))
    calls = []
    fn = lambda b: b["part"] + ""
    run = ["translate", "--extracted", f"{t}/ext", "--ledger", f"{t}/led", "--to", "ja", "--out", f"{t}/tr", "--memory", f"{t}/tm",
           "--manifest-out", f"{t}/hours"]
    jobs.run_translate(spark, jobs.parser().parse_args([*run, "--quota", "1"]))
    q = flows.translate_stream(spark, f"{t}/ext", f"{t}/tr", f"{t}/led", f"{scratch}/ck", "ja", translate_fn=fn,
                               memory_path=f"{t}/tm", once=False, interval="1 second")
    import time
    try:
        end = time.time() + 90
        while time.time() < end:
            led = spark.read.parquet(f"{t}/led").filter("stage = 'translate_ja'")
            if led.count() == len(paths):
                break
            time.sleep(0.5)
    finally:
        q.stop()
    tr = spark.read.parquet(f"{t}/tr")
    assert tr.count() == len(paths) and "arrival" in tr.columns and tr.select("arrival").distinct().count() == len(paths)
    tm = spark.read.parquet(f"{t}/tm")
    assert tm.filter("from_lang = 'fr'").count() == 1                # the sidecar's language, not the region's
    assert spark.read.parquet(f"{t}/hours").count() >= 1
    i = jobs.parser().parse_args(["index", "--translated", f"{t}/tr", "--root", root, "--history", f"{t}/index", "--run-id", "1", "--ledger", f"{t}/led"])
    jobs.run_index(spark, i)
    newest = spark.read.parquet(f"{t}/index/newest-1")
    assert newest.count() >= 1 and spark.read.parquet(f"{t}/led").filter("stage = 'index'").count() == newest.count()
    assert not calls


def test_existing_target_is_status_5(spark, scratch):
    root, man, t = f"{scratch}/html", f"{scratch}/manifests", f"{scratch}/tables"
    _tree(root, man)
    flows.extract_stream(spark, man, root, f"{t}/ext", f"{t}/led", today=dt.date(2024, 1, 9))
    while flows.translate_stream(spark, f"{t}/ext", f"{t}/tr", f"{t}/led", None, "ja", quota=1):
        pass
    n = spark.read.parquet(f"{t}/tr").count()
    flows.translate_stream(spark, f"{t}/ext", f"{t}/tr", f"{t}/led2", None, "ja")       # another ledger, the same targets
    assert spark.read.parquet(f"{t}/tr").filter("status = 0").count() == 2 and spark.read.parquet(f"{t}/tr").count() >= n
    assert spark.read.parquet(f"{t}/led2").filter("status = 5").count() >= 1


def test_short_paths_are_skipped_by_the_index(spark):
    tr = spark.createDataFrame([(f"/x/{i}.html", "ja", 0, "text", i) for i in range(5)], "page_path string, to_lang string, status int, translated string, arrival long")
    urls = tr.select("page_path", F.lit("https://a/b").alias("url"))
    newest, first, skipped = flows.index_flow(tr, urls, "/root")
    assert (newest.count(), first.count(), skipped.count()) == (0, 0, 5)


def count_letters(df):
    """A scorer for the sentiment job's test."""
    return df.withColumn("sentiment", F.length("title").cast("double"))


def test_classify_and_sentiment_jobs(spark, scratch):
    """From page tree to sentiment lines; nothing is repeated, and a run that
    died between its output and its ledger lines is done again once."""
    import json

    from docflow import jobs
    root, man, t = f"{scratch}/html", f"{scratch}/manifests", f"{scratch}/tables"
    paths = _tree(root, man)
    flows.extract_stream(spark, man, root, f"{t}/ext", f"{t}/led", today=dt.date(2024, 1, 9))
    for lang in ("ja", "en"):
        flows.translate_stream(spark, f"{t}/ext", f"{t}/tr", f"{t}/led", None, lang)
    classify = jobs.parser().parse_args(["classify", "--extracted", f"{t}/ext", "--translated", f"{t}/tr", "--root", root, "--out", f"{t}/cls", "--ledger", f"{t}/led"])
    score = jobs.parser().parse_args(["sentiment", "--classified", f"{t}/cls", "--root", root, "--out", f"{t}/sent", "--ledger", f"{t}/led",
                                      "--scorer", "tests.test_flows:count_letters"])
    lines = lambda p: sorted(r[0] for r in spark.read.text(p).select("value").collect())
    orig, flows.append_ledger = flows.append_ledger, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost"))
    try:
        jobs.run_classify(spark, classify)
    except RuntimeError:
        pass
    finally:
        flows.append_ledger = orig
    before = lines(f"{t}/cls")
    for _ in range(2):
        jobs.run_classify(spark, classify)
        jobs.run_sentiment(spark, score)
    assert lines(f"{t}/cls") == before
    got = [json.loads(x) for x in before]
    assert sorted(f"{root}/{x['orig']['file']}" for x in got) == sorted(paths[:2])
    sent = {json.loads(x)["file"]: json.loads(x)["sentiment"] for x in lines(f"{t}/sent")}
    assert set(sent) == set(paths[:2]) and len(lines(f"{t}/sent")) == 2 and sent[paths[0]] == len("新型コロナ")
    led = spark.read.parquet(f"{t}/led")
    assert led.filter("stage = 'classify'").count() == 2 and led.filter("stage = 'sentiment'").count() == 2
