"""Goldens for path parsing (P1-P9, P11) and HTML block rules (X2-X5,
F12, F13, S12)."""

import datetime as dt

from pyspark.sql import functions as F

from docflow.functions import html as H
from docflow.functions import paths as P
from docflow.operators.pages import page_features
from docflow.sources.files import parse_block_xml, parse_meta

ROOT = "/data/html"


def _rows(spark, values, *cols):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return df.select(*cols).collect()


def test_page_parts(spark):
    p = f"{ROOT}/jp/ja_translated/www.site.jp/news/a/2021/03/05-14-30/page1.txt"
    r = _rows(spark, [p], P.page_parts("s", ROOT, tz="Asia/Tokyo").alias("x"))[0]["x"]
    assert (r.region, r.site, r.path, r.year, r.month, r.day, r.hh, r.mm, r.filename) == \
        ("jp", "www.site.jp", "news/a", 2021, 3, 5, 14, 30, "page1")
    assert r.record_id == "jp/www.site.jp/news/a/page1"
    assert r.ts_local == dt.datetime(2021, 3, 5, 14, 30)
    assert r.ts_utc == dt.datetime(2021, 3, 5, 5, 30)


def test_page_parts_bad_path_is_null(spark):
    r = _rows(spark, [f"{ROOT}/jp/orig/x.html", f"{ROOT}/jp/orig/s/2021/xx/05-14-30/p.txt"],
              P.page_parts("s", ROOT).alias("x"))
    assert r[0]["x"] is None
    assert r[1]["x"].month is None and r[1]["x"].ts_local is None


def test_tweet_parts(spark):
    r = _rows(spark, [f"{ROOT}/jp/orig/2021/03/05/14-30/12345.txt"], P.tweet_parts("s", ROOT).alias("x"))[0]["x"]
    assert (r.country, r.year, r.month, r.day, r.hh, r.mm, r.record_id) == ("jp", 2021, 3, 5, 14, 30, "12345")


def test_parse_iso(spark):
    r = _rows(spark, ["2021-03-05T14:30:15.123+09:00", "bad"], P.parse_iso("s").alias("t"))
    assert r[0]["t"] == dt.datetime(2021, 3, 5, 14, 30, 15) and r[1]["t"] is None


def test_stage_mapping(spark):
    p = f"{ROOT}/jp/orig/site/orig/x.html"
    r = _rows(spark, [p], P.stage_path("s", "orig", "tmp", ".title_main").alias("a"),
              P.stage_path("s", "orig", "ja_translated").alias("b"))[0]
    assert r["a"] == f"{ROOT}/jp/tmp/site/orig/x.title_main"
    assert r["b"] == f"{ROOT}/jp/ja_translated/site/orig/x.html"
    w = _rows(spark, ["a/b.c/d.html", "a/b/d", "a/.hidden", "a/x.tar.gz"], P.with_suffix("s", ".txt").alias("w"))
    assert [x["w"] for x in w] == ["a/b.c/d.txt", "a/b/d.txt", "a/.hidden.txt", "a/x.tar.txt"]


def test_feature_key(spark):
    a = f"{ROOT}/jp/orig/site/news/2021/03/05-14-30/page1.html"
    b = f"{ROOT}/jp/ja_translated/site/news/2021/03/05-14-30/page1.txt"
    c = f"{ROOT}/jp/orig"
    r = _rows(spark, [a, b, c], P.feature_key("s", ROOT).alias("k"), P.feature_key("s", ROOT, legacy=True).alias("l"))
    assert r[0]["k"] == r[1]["k"] == "jp/site/news/2021/03/05-14-30/page1"
    assert r[0]["l"] == "news/2021/03/05-14-30/page1."
    assert r[1]["l"] == "news/2021/03/05-14-30/page1."
    assert r[2]["k"] is None and r[2]["l"] == ""


def test_region_site_and_relative(spark):
    r = _rows(spark, [f"{ROOT}/in/orig/s1/x.html", f"{ROOT}/int/orig/s2/x.html", f"{ROOT}/zz/orig/s3/x.html"],
              P.region_of("s", ROOT).alias("r"), P.site_of("s", ROOT).alias("s"),
              P.absolute_to_relative("s", ROOT).alias("rel"))
    assert [(x["r"], x["s"]) for x in r] == [("in", "s1"), ("int", "s2"), (None, "s3")]
    assert r[0]["rel"] == "./in/orig/s1/x.html"
    back = _rows(spark, ["./in/orig/s1/x.html"], P.relative_to_absolute("s", ROOT).alias("a"))[0]["a"]
    assert back == f"{ROOT}/in/orig/s1/x.html"


def test_crawl_time_key_orders_newest_first(spark):
    vals = [f"{ROOT}/jp/orig/s/2021/03/05-14-30/a.html", f"{ROOT}/jp/orig/s/2022/01/01-00-00/b.html"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r["s"][-6:] for r in df.orderBy(P.crawl_time_key("s")).collect()] == ["b.html", "a.html"]


def test_url_parts(spark):
    r = _rows(spark, ["https://user@Example.COM:8080/fr/a/b.html?x=1#t"], P.url_host("s").alias("h"),
              P.url_path("s").alias("p"))[0]
    assert (r["h"], r["p"]) == ("example.com", "/fr/a/b.html")


PAGES = [
    (1, '<html><head><title>T &amp; U</title></head><body><h1><a href="/">Site</a></h1><h1>Main title</h1>'
        '<p>short</p><ul><li><a href="/1">one</a></li><li><a href="/2">two</a></li></ul></body></html>'),
    (2, '<h2>Title</h2><p>x</p><div><a href="/z">aaaaaaaaaaaa</a></div>'),
    (3, '<div>no heading</div><p>text <strong>bold</strong></p>'),
    (4, '<h1>T</h1><div><a href="/l">link</a></div><!-- <p>hidden</p> --><script>var p="<p>";</script>'),
]


def test_page_feature_goldens(spark):
    df = spark.createDataFrame(PAGES, "page_id long, html string")
    f = {r["page_id"]: r for r in page_features(df, url=None).collect()}
    assert f[1]["title"] == "T & U"
    assert f[1]["main_heading"] == "Main title" and f[1]["heading_level"] == 1
    assert f[1]["link_list"] is True
    assert f[1]["link_dominated"] is False          # anchors 6 chars vs 2 x 5
    assert (f[1]["content_num"], f[1]["link_num"]) == (2, 3)
    assert f[1]["first_h1"] == "Site" and f[1]["first_par"] == "short"
    assert f[2]["main_heading"] == "Title" and f[2]["heading_level"] == 2
    assert f[2]["link_dominated"] is True           # 12 > 2 x 1
    assert f[3]["main_heading"] is None and f[3]["link_dominated"] is None
    assert f[3]["first_h1"] == "" and f[3]["link_list"] is False
    assert f[4]["link_dominated"] is False          # no p/strong text after the heading
    assert f[4]["text"] == "T"                      # comment and script removed


def test_blocks_table_positions(spark):
    from docflow.operators.pages import blocks_table
    df = spark.createDataFrame([(1, "<p>a</p><li><a>b</a></li>")], "page_id long, html string")
    rows = [(r.pos, r.tag, r.is_link, r.text) for r in blocks_table(df).orderBy("pos").collect()]
    assert rows == [(0, "", False, ""), (1, "p", False, "a"), (2, "/p", False, ""), (3, "li", True, "b"),
                    (4, "/li", False, "")]


XML = ('<Doc><Title><RawString>My title</RawString></Title>'
       '<S BlockType="maintext"><RawString>first</RawString></S>'
       '<S BlockType="unknown_block"><RawString>second</RawString></S>'
       '<S BlockType="other"><RawString>nav</RawString></S>'
       '<S BlockType="maintext"><RawString></RawString></S></Doc>')


def test_block_xml(spark):
    r = _rows(spark, [XML], parse_block_xml("s").alias("x"))[0]["x"]
    assert r.title == "My title"
    assert r.text == "My title\nfirst\nsecond"
    assert (r.content_num, r.link_num) == (3, 1)


def test_meta_line(spark):
    vals = ["0 1600000000.5 jp 10 3 True", "0 1.0 cn 1 2 False\n", "", "0 1.0 jp", "x 1.0 jp 1 2 True"]
    r = [x["m"] for x in _rows(spark, vals, parse_meta("s").alias("m"))]
    assert (r[0].mtime, r[0].domain, r[0].content_num, r[0].link_num, r[0].keyword_flag) == \
        (1600000000.5, "jp", 10, 3, True)
    assert r[1].keyword_flag is False
    assert r[2] is None and r[3] is None and r[4] is None


def test_prepend_h1(spark):
    from docflow.operators.pages import prepend_h1
    df = spark.createDataFrame([("www.zusammengegencorona.de", "H", "body"), ("other", "H", "body")],
                               "site string, first_h1 string, text string")
    assert [r["text"] for r in prepend_h1(df).collect()] == ["H\nbody", "body"]


def test_character_references(spark):
    import html
    texts = ["a &amp;lt; b &lt; c", "&eacute;t&eacute; &mdash; &#8217; &#x1F600; &#X41;", "&copy &nosuch; &; & &&amp;", "&middot;", "&#0; &#xD800; &#99999999;", "no reference", ""]
    rows = _rows(spark, texts, H.decode_entities(F.col("s")).alias("t"))
    got = [r["t"] for r in sorted(rows, key=lambda r: r["i"])] if "i" in rows[0].asDict() else [r["t"] for r in rows]
    want = [html.unescape(t) for t in texts]
    want[2] = "&copy &nosuch; &; & &&"              # a reference needs its semicolon
    want[4] = "\ufffd \ufffd &#99999999;"            # more digits than any code point: left as text
    assert got == want


def test_entities_decoded_last_amp(spark):
    r = _rows(spark, ["<p>a &amp;lt; b &lt; c&nbsp;d</p>"], H.tag_text(F.col("s")).alias("t"))[0]["t"]
    assert r == "a &lt; b < c d"


def test_heading_goes_to_h9(spark):
    df = spark.createDataFrame([(1, "<h2><a>x</a></h2><h8>Deep</h8><p>t</p>")], "page_id long, html string")
    f = page_features(df, url=None, features=["main_heading", "heading_level"]).first()
    assert (f["main_heading"], f["heading_level"]) == ("Deep", 8)
