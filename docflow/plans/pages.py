"""Queries over ``pages`` (X2-X5, A2, F1, F3, F8, F12, F13, P6, P9, A9, J6,
J7, K1, K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.constants import COVID_KEYWORDS
from docflow.functions.paths import url_host, url_path
from docflow.functions.similarity import edit_distance, text_overlap, word_set
from docflow.functions.text import keyword_flag
from docflow.operators import similar
from docflow.operators.latest import index_records
from docflow.operators.ledger import ok_items
from docflow.operators.pages import blocks_table, page_features
from docflow.operators.ranking import written
from docflow.operators.routing import density_ok, page_status
from docflow.plans.common import read
from docflow.plans.sqlparts import URL, blocks_cte, features_cte, heading_cte, keyword_sql, q, status_sql
from docflow.plans.sqlparts import text_overlap as overlap_sql

# Keyword list for the status queries over the synthetic pages: the real
# list (constants.COVID_KEYWORDS) never occurs in them, which would leave
# every page at status 1.  A frequent fragment exercises the whole cascade.
PAGE_KEYWORDS = ["tion"]
CODE_KEYWORDS = [*PAGE_KEYWORDS, "日"]
TO_LANG = "ja"
# Limits under which the synthetic pages reach codes 0, 1, 2, 7 and 9 and both
# values of every flag (the original's limits leave the flags constant).
PAGE_LIMITS = {"density": 0.6, "max_lines": 20, "routes": {"ja": ["en", "fr", "de"]}}
LIST_MAX_P = 1000
LINK_FACTOR = 0.05
STATUS_FEATURES = ["html_lang", "content_num", "link_num", "text", "n_lines"]


def q_page_blocks(spark, sf):
    """One row per block."""
    return blocks_table(read(spark, sf, "pages"))


def q_block_counts(spark, sf):
    """A2 + title: content and link block counts per page."""
    f = page_features(read(spark, sf, "pages"), url=None, features=["title", "content_num", "link_num"])
    return f.select("page_id", "title", "content_num", "link_num")


def q_page_headings(spark, sf):
    """First paragraph, first h1, main heading; the h1 of every
    third page is made an h3, so that lower levels are searched too."""
    p = read(spark, sf, "pages")
    lower = F.replace(F.replace("html", F.lit("<h1"), F.lit("<h3")), F.lit("</h1"), F.lit("</h3"))
    p = p.withColumn("html", F.when(F.col("page_id") % 3 == 0, lower).otherwise(F.col("html")))
    f = page_features(p, url=None,
                      features=["first_par", "first_h1", "main_heading", "heading_level"])
    return f.select("page_id", "first_par", "first_h1", "main_heading", "heading_level")


def q_link_flags(spark, sf):
    """link-list page and link-dominated page.  Each page is read
    twice over, so that its own links follow its heading."""
    p = read(spark, sf, "pages").withColumn("html", F.concat("html", "html"))
    f = page_features(p, url=None, features=["link_list", "link_dominated"], list_limits={"max_p": LIST_MAX_P}, link_factor=LINK_FACTOR)
    return f.select("page_id", "link_list", "link_dominated")


def q_density_filter(spark, sf):
    """pages that pass the link-density rule."""
    f = page_features(read(spark, sf, "pages"), features=["content_num", "link_num"])
    return (f.withColumn("keep", density_ok("content_num", "link_num", "region", PAGE_LIMITS["density"]))
            .select("page_id", "content_num", "link_num", "keep"))


def page_status_rows(spark, sf, to_lang=TO_LANG, keywords=PAGE_KEYWORDS):
    f = page_features(read(spark, sf, "pages"), features=STATUS_FEATURES)
    return page_status(f, to_lang, keywords, **PAGE_LIMITS)


def q_page_status(spark, sf):
    """Flagship: blocks -> counts -> keyword -> language -> density ->
    status cascade -> count per (language, status)."""
    s = page_status_rows(spark, sf)
    return s.groupBy("src_lang", "status").agg(F.count(F.lit(1)).alias("n"))


def q_page_codes(spark, sf):
    """F8 with every code the cascade gives, F6 and F7 included, one row per
    page: every seventh page has lost its content (4), every eleventh is cut
    to one character that is its keyword (3), and the target's ledger (S6)
    holds every fifth page (5)."""
    p = read(spark, sf, "pages")
    html = (F.when(F.col("page_id") % 7 == 0, F.lit("<p></p>")).when(F.col("page_id") % 11 == 0, F.lit("<p>日</p>")).otherwise(F.col("html")))
    f = page_features(p.withColumn("html", html), features=STATUS_FEATURES)
    ledger = p.filter(F.col("page_id") % 5 == 0).select("page_id", (F.col("page_id") % 2).cast("int").alias("status"))
    done = written(ok_items(ledger, "page_id"), "target-ledger")
    s = page_status(f, TO_LANG, CODE_KEYWORDS, done=done, **PAGE_LIMITS)
    return s.select("page_id", "src_lang", "status")


def q_url_parts(spark, sf):
    """P9 + P6 on URLs: host (site), region folder, path, version-free key."""
    p = read(spark, sf, "pages", heavy=False).select("page_id", "url")
    path = url_path("url")
    stem = F.regexp_replace(path, r"(?<=[^/])\.[^./]+\z", "")
    return p.select(
        "page_id", url_host("url").alias("site"),
        F.regexp_extract(path, r"\A/([^/]+)/", 1).alias("region"),
        path.alias("path"),
        F.concat(url_host("url"), stem).alias("feature"))


def q_title_similarity(spark, sf):
    """J6/J7 on natural pairs: page title vs main heading and first
    paragraph (one row per page, no pair generation)."""
    f = page_features(read(spark, sf, "pages"), url=None, features=["title", "main_heading", "first_par"])
    return f.select(
        "page_id",
        edit_distance("title", F.coalesce("main_heading", F.lit(""))).alias("title_heading_dist"),
        edit_distance("title", "first_par").alias("title_par_dist"),
        F.round(text_overlap("title", "first_par"), 6).alias("title_par_overlap"))


def q_title_overlap(spark, sf):
    """J6 on a natural pair: page title vs first paragraph."""
    f = page_features(read(spark, sf, "pages"), url=None, features=["title", "first_par"])
    return f.select("page_id", F.round(text_overlap("title", "first_par"), 6).alias("title_par_overlap"))


SIMILAR_TITLES = 0.8
TITLE_EDITS = 8


def q_similar_titles(spark, sf):
    """J6 as a join: the pages whose titles have equal words are a class; each
    page with the number of other classes that share 0.8 of the smaller
    title's words, and the largest overlap."""
    f = page_features(read(spark, sf, "pages"), url=None, features=["title"])
    rows = written(f.select("page_id", F.array_sort(word_set("title")).alias("words")), "titles")
    rows = written(similar.with_classes(rows, "page_id", ["words"]), "title-classes")
    sets = rows.filter("page_id = class_id").select(F.col("class_id").alias("id"), F.col("words").alias("tokens"))
    out = similar.links(rows, similar.overlap_pairs(sets, SIMILAR_TITLES), F.max("overlap"))
    return out.select("page_id", "class_id", "n_links", F.round("best", 6).alias("best"))


def q_near_titles(spark, sf):
    """J7 as a join: the pages of a folder with equal titles are a class; each
    page with the number of other classes of its folder whose titles are at
    most 8 edits away, and the least distance."""
    f = page_features(read(spark, sf, "pages"), features=["title"])
    rows = written(f.select("page_id", F.regexp_extract(url_path("url"), r"\A/([^/]+)/", 1).alias("folder"), "title"), "titles")
    rows = written(similar.with_classes(rows, "page_id", ["folder", "title"]), "title-classes")
    strings = rows.filter("page_id = class_id").select(F.col("class_id").alias("id"), F.col("folder").alias("block"), F.col("title").alias("s"))
    out = similar.links(rows, similar.edit_pairs(strings, TITLE_EDITS), F.min("distance"))
    return out.select("page_id", "class_id", "n_links", "best")


def q_extracted(spark, sf):
    """K1 record of the extraction stage: region, site, counts, keyword flag
    with the original keyword list, line count, text digest."""
    f = page_features(read(spark, sf, "pages"), features=STATUS_FEATURES)
    return f.select("page_id", "region", "site", "content_num", "link_num",
                    keyword_flag("text", COVID_KEYWORDS).alias("keyword_flag"),
                    "n_lines", F.md5("text").alias("text_md5"))


def q_index_pages(spark, sf):
    """K8 + K6 record fields: pages that reached status 0 and have a URL
    become index records (id = region/site/path, url, region, text digest);
    the rest are skipped."""
    s = page_status_rows(spark, sf)
    # status 0 implies a non-empty text, so the items carry it (one pass)
    items = s.filter(F.col("status") == 0).select("page_id", "region", "site", F.md5("text").alias("text_md5"))
    urls = read(spark, sf, "pages", heavy=False).select("page_id", "url").filter(F.col("url").isNotNull())
    rec, _skipped = index_records(items, urls, None, "page_id")
    return rec.select("page_id", F.concat_ws("/", "region", "site", url_path("url")).alias("record_id"),
                      "url", "region", "text_md5")


QUERIES = {
    "page_blocks": q_page_blocks,
    "block_counts": q_block_counts,
    "page_headings": q_page_headings,
    "link_flags": q_link_flags,
    "density_filter": q_density_filter,
    "page_status": q_page_status, "page_codes": q_page_codes,
    "url_parts": q_url_parts,
    "title_similarity": q_title_similarity,
    "title_overlap": q_title_overlap,
    "similar_titles": q_similar_titles,
    "near_titles": q_near_titles,
    "extracted": q_extracted,
    "index_pages": q_index_pages,
}

# ---------------------------------------------------------------- oracles
_FEAT = f"WITH {blocks_cte()}, {heading_cte()}, {features_cte()}"
_SITE = (f"lower(regexp_replace(regexp_replace(regexp_extract(url, {q(URL)}, 2), '\\A.*@', ''), "
         f"':[0-9]*\\z', ''))")
_PATH = f"regexp_extract(url, {q(URL)}, 3)"
_STATUS = status_sql("src_lang", f"'{TO_LANG}'", "length(text) > 0", keyword_sql("text", PAGE_KEYWORDS),
                     "content_num", "link_num", "n_lines", "length(text)", region="region", **PAGE_LIMITS)

_CODES = status_sql("src_lang", f"'{TO_LANG}'", "length(text) > 0", keyword_sql("text", CODE_KEYWORDS),
                    "content_num", "link_num", "n_lines", "length(text)", region="region", **PAGE_LIMITS)


def _with_pages(html: str, **limits) -> str:
    """Feature CTEs over pages whose html is ``html``."""
    return f"""WITH page2 AS (SELECT page_id, url, {html} AS html FROM pages),
        {blocks_cte("page2")}, {heading_cte()}, {features_cte(table="page2", **limits)} """


# DuckDB's levenshtein counts bytes: each accented letter of the tables gets
# a control character of its own first, which changes no distance.
_ACCENTED = "ßÉÈÑüóöÓÖéèÍêçÇíäÜñÄÊ"
_ONE_BYTE = "translate({}, '" + _ACCENTED + "', '" + "".join(chr(c) for c in [*range(1, 9), *range(14, 32)][:len(_ACCENTED)]) + "')"

SQL = {
    "page_blocks": f"WITH {blocks_cte()} SELECT page_id, pos, tag, is_link, text FROM blk",
    "block_counts": f"{_FEAT} SELECT page_id, title, content_num, link_num FROM feat",
    "page_headings": _with_pages("CASE WHEN page_id % 3 = 0 THEN replace(replace(html, '<h1', '<h3'), '</h1', '</h3') ELSE html END")
    + "SELECT page_id, first_par, first_h1, main_heading, heading_level FROM feat",
    "link_flags": _with_pages("html || html", max_p=LIST_MAX_P, factor=LINK_FACTOR) + "SELECT page_id, link_list, link_dominated FROM feat",
    "density_filter": f"""{_FEAT}
        SELECT page_id, content_num, link_num,
               (NOT ((content_num + 1) / (content_num + link_num + 1) < {PAGE_LIMITS['density']}) OR coalesce(region = 'my', false)) AS keep
        FROM feat2""",
    "page_status": f"{_FEAT} SELECT src_lang, {_STATUS} AS status, count(*) AS n FROM feat2 GROUP BY ALL",
    "page_codes": _with_pages("CASE WHEN page_id % 7 = 0 THEN '<p></p>' WHEN page_id % 11 = 0 THEN '<p>日</p>' ELSE html END")
    + f"SELECT page_id, src_lang, CASE WHEN page_id % 10 = 0 AND {_CODES} <> 9 THEN 5 ELSE {_CODES} END AS status FROM feat2",
    "url_parts": f"""
        WITH u AS (SELECT page_id, {_SITE} AS site, {_PATH} AS path FROM pages)
        SELECT page_id, site, regexp_extract(path, '\\A/([^/]+)/', 1) AS region, path,
               site || regexp_replace(path, '([^/])\\.[^./]+\\z', '\\1') AS feature
        FROM u""",
    "title_similarity": f"""{_FEAT},
        t AS (SELECT page_id, title, first_par, coalesce(main_heading, '') AS heading FROM feat)
        SELECT page_id, CAST(levenshtein({_ONE_BYTE.format('title')}, {_ONE_BYTE.format('heading')}) AS INTEGER) AS title_heading_dist,
               CAST(levenshtein({_ONE_BYTE.format('title')}, {_ONE_BYTE.format('first_par')}) AS INTEGER) AS title_par_dist,
               round({overlap_sql('title', 'first_par')}, 6) AS title_par_overlap FROM t""",
    "title_overlap": f"""{_FEAT}
        SELECT page_id, round({overlap_sql('title', 'first_par')}, 6) AS title_par_overlap FROM feat""",
    "similar_titles": f"""{_FEAT},
        t AS (SELECT page_id, list_sort(list_distinct(list_filter(string_split_regex(title, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''))) AS w FROM feat),
        c AS (SELECT page_id, w, min(page_id) OVER (PARTITION BY w) AS class_id FROM t),
        k AS (SELECT DISTINCT class_id, w FROM c WHERE len(w) > 0),
        p AS (SELECT a.class_id, len(list_intersect(a.w, b.w)) / least(len(a.w), len(b.w)) AS o FROM k a JOIN k b ON a.class_id <> b.class_id
              AND len(list_intersect(a.w, b.w)) * 10 >= least(len(a.w), len(b.w)) * {round(SIMILAR_TITLES * 10)}),
        n AS (SELECT class_id, count(*) AS n_links, max(o) AS best FROM p GROUP BY class_id)
        SELECT page_id, c.class_id, coalesce(n_links, 0) AS n_links, round(best, 6) AS best FROM c LEFT JOIN n USING (class_id)""",
    "near_titles": f"""{_FEAT},
        t AS (SELECT feat.page_id, regexp_extract({_PATH}, '\\A/([^/]+)/', 1) AS folder, title, {_ONE_BYTE.format('title')} AS s FROM feat),
        c AS (SELECT page_id, folder, s, min(page_id) OVER (PARTITION BY folder, title) AS class_id FROM t),
        k AS (SELECT DISTINCT class_id, folder, s FROM c),
        p AS (SELECT a.class_id, levenshtein(a.s, b.s) AS d FROM k a JOIN k b ON a.class_id <> b.class_id AND a.folder IS NOT DISTINCT FROM b.folder),
        n AS (SELECT class_id, count(*) AS n_links, CAST(min(d) AS INTEGER) AS best FROM p WHERE d <= {TITLE_EDITS} GROUP BY class_id)
        SELECT page_id, c.class_id, coalesce(n_links, 0) AS n_links, best FROM c LEFT JOIN n USING (class_id)""",
    "extracted": f"""{_FEAT}
        SELECT page_id, region, {_SITE} AS site, content_num, link_num,
               {keyword_sql('text', COVID_KEYWORDS)} AS keyword_flag, CAST(n_lines AS BIGINT) AS n_lines,
               md5(text) AS text_md5 FROM feat2""",
    "index_pages": f"""{_FEAT}
        SELECT page_id, concat_ws('/', region, {_SITE}, {_PATH}) AS record_id, url, region, md5(text) AS text_md5
        FROM feat2 WHERE {_STATUS} = 0 AND url IS NOT NULL""",
}
