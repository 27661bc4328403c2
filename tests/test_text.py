"""Goldens and brute-force checks for the text rules (A7, F4, F9-F11,
X6-X10, P12, J6, J7)."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from docflow.functions import similarity as SIM
from docflow.functions import text as T
from docflow.operators.packing import pack
from tests.conftest import SF_CHECK


def _one(spark, col_fn, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("s"))).collect()]


def greedy_parts(text, limit=300):
    """Brute force of the packing rule: add whole lines (with newline)
    while the part stays under ``limit``; parts stripped; empty ones dropped."""
    out, cur = [], ""
    for line in text.split("\n"):
        nxt = cur + line + "\n"
        if len(nxt) < limit:
            cur = nxt
            continue
        out.append(cur)
        cur = line + "\n"
    out.append(cur)
    return [p.strip() for p in out if p.strip()]


@pytest.mark.parametrize("text,expected", [
    ("a" * 298, ["a" * 298]),
    ("a" * 299, ["a" * 299]),
    ("a" * 150 + "\n" + "b" * 149, ["a" * 150, "b" * 149]),
    ("a" * 400 + "\nb", ["a" * 400, "b"]),
    ("x", ["x"]),
    ("", []),
    ("\n\n  \n", []),
])
def test_pack_goldens(spark, text, expected):
    assert _one(spark, pack, [text])[0] == expected


def test_pack_matches_brute_force_on_documents(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", pack("text").alias("p")).collect()
    for r in rows:
        assert r["p"] == greedy_parts(r["text"]), r["doc_id"]
        assert all(len(p) < 300 or "\n" not in p for p in r["p"])


def test_too_long_501_lines(spark):
    t = "\n".join(["x"] * 501)
    assert _one(spark, lambda c: T.too_long(c, 500), [t, "\n".join(["x"] * 500)]) == [True, False]


def test_mostly_latin(spark):
    assert _one(spark, T.mostly_latin, ["a" * 199, "a" * 200, "あ" * 100 + "a" * 150, "ab " * 100]) == \
        [False, True, False, True]


@pytest.mark.parametrize("s,expected", [
    ("5月の発表", True), ("in 2020", True), ("1995年", True), ("199５", True), ("平成", True),
    ("昭和の", True), ("H30年", True), ("H40", False), ("nothing", False)])
def test_date_mention(spark, s, expected):
    assert _one(spark, T.date_mention, [s])[0] is expected


def test_link_word(spark):
    assert _one(spark, T.link_word, ["関連リンク", "link"]) == [True, False]


def test_clean_ja_and_en(spark):
    vals = ["  日本 語\tテキスト　です  ", "Mostly latin text here　日", "市の情報-丹波市ホームページ",
            "\tabc\t"]
    assert _one(spark, T.clean_ja, vals) == ["日本語テキストです", "Mostly latin text here　日", "市の情報", "abc"]
    assert _one(spark, T.clean_en, ["\ta\tb\n", " x "]) == ["a b", "x"]


def test_guard_tags(spark):
    got = _one(spark, T.guard_tags, ["see https://a.b/c#d now #tag ＃タグ end", "no tags"])
    assert got[0] == "see  ｟https://a.b/c#d ｠  now  ｟#tag  ｠  ｟＃タグ  ｠ end"
    assert got[1] == "no tags"


def test_newline_runs(spark):
    df = spark.createDataFrame([("\n\nab\ncd\n",), ("x",), ("\n",)], "s string")
    r = df.select(T.leading_newlines("s"), T.trailing_newlines("s")).collect()
    assert [tuple(x) for x in r] == [("\n\n", "\n"), ("", ""), ("\n", "")]


def test_render_html(spark):
    got = _one(spark, T.render_html, ["a\nb"])[0]
    assert got == '<html>\n<head><meta charset="utf-8"/></head>\n<body>\n<p>a</p>\n<p>b</p>\n</body>\n</html>\n'
    esc = _one(spark, lambda c: T.render_html(c, escape=True), ["<b>&"])[0]
    assert "<p>&lt;b&gt;&amp;</p>" in esc


@pytest.mark.parametrize("title,expected", [
    ("ＣＯＶＩＤ　感染 − ニュース", "COVID感染"), ("タイトル|サイト名", "タイトル"),
    ("AーYahoo", "A"), ("ends−", "ends−"), ("plain", "plain")])
def test_clean_title(spark, title, expected):
    assert _one(spark, T.clean_title, [title])[0] == expected
    assert unicodedata.normalize("NFKC", expected) == expected


def test_keyword_flag_case(spark):
    from docflow.constants import COVID_KEYWORDS
    assert _one(spark, lambda c: T.keyword_flag(c, COVID_KEYWORDS), ["Covid", "新型コロナ", "COVID-19"]) == \
        [False, True, True]
    assert _one(spark, lambda c: T.keyword_flag(c, COVID_KEYWORDS, ignore_case=True), ["Covid"]) == [True]
    long = [f"term{i}" for i in range(200)] + ["needle"]
    assert _one(spark, lambda c: T.keyword_flag(c, long), ["a needle", "none", "x.y"]) == [True, False, False]


def edit_dp(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("a,b", [("", ""), ("abc", ""), ("kitten", "sitting"), ("été", "ete"), ("日本", "日木")])
def test_edit_distance(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(SIM.edit_distance("a", "b")).first()[0] == edit_dp(a, b)


def test_title_similarity_matches_brute_force(spark):
    import __spark_entry__ as E
    from docflow.operators.pages import page_features
    got = {r["page_id"]: r["title_heading_dist"] for r in E.queries()["title_similarity"](spark, SF_CHECK).collect()}
    f = page_features(spark.read.parquet(f"{SF_CHECK}/pages.parquet"), url=None).select(
        "page_id", "title", "main_heading").collect()
    for r in f:
        assert got[r["page_id"]] == edit_dp(r["title"], r["main_heading"] or "")


def word_overlap_ref(a, b):
    x, y = set(a.split()), set(b.split())
    m = min(len(x), len(y))
    return 0.0 if m == 0 else len(x & y) / m


@pytest.mark.parametrize("a,b", [("a b c", "b c d"), ("", "x"), ("x y", "y x x"), ("one", "two")])
def test_word_overlap(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    r = df.select(SIM.word_overlap("a", "b"), SIM.word_overlap("b", "a")).first()
    assert r[0] == pytest.approx(word_overlap_ref(a, b))
    assert r[0] == r[1] and 0.0 <= r[0] <= 1.0


def test_bigram_overlap_cjk(spark):
    df = spark.createDataFrame([("東京都の感染", "東京都で感染")], "a string, b string")
    v = df.select(SIM.text_overlap("a", "b")).first()[0]
    # bigrams: {東京,京都,都の,の感,感染} vs {東京,京都,都で,で感,感染}: 3 shared of 5
    assert v == pytest.approx(0.6)


def test_short_output_and_page_helpers(spark):
    assert _one(spark, T.is_short, ["", "a", "ab", None]) == [True, True, False, True]
    from docflow.functions import html as H
    from docflow.operators.pages import keyword_pages, page_features
    df = spark.createDataFrame([(1, "<p>a</p><p><a>l</a></p><p>b corona</p>")], "page_id long, html string")
    assert df.select(H.content_text(H.blocks("html"))).first()[0] == "a\nb corona"
    f = keyword_pages(page_features(df, url=None, features=["text"]), ["corona"])
    assert f.first()["keyword_flag"] is True
