"""DuckDB SQL fragments that restate the Spark expressions independently.

They mirror the rules (not the code) of ``docflow.functions``: the same
regexes, written for RE2, applied with SQL set operations instead of arrays.
"""

from __future__ import annotations

from docflow.constants import JA_SITE_SUFFIXES, REGION_LANG, ROUTE_SOURCES

# The oracle's own patterns (RE2), so that a wrong pattern in the library shows.
PRE_STRIP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<title\b.*?</title>"
BLOCK_TAG = r"(?i)</?(?:p|li|h[1-9]|div|ul|ol|nav|article|section|header|footer|tr|td|table|body|html)\b[^>]*>"
TAG_NAME = r"^<(/?[a-zA-Z0-9]+)"
LINK = r"(?i)<a\b"
ANY_TAG = r"<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
ANCHOR_TEXT = r"(?is)<a\b[^>]*>(.*?)</a>"
STRONG_TEXT = r"(?is)<strong\b[^>]*>(.*?)</strong>"
HTML_LANG = r'''(?i)<html\b[^>]*\blang=[\"']?([a-zA-Z_-]+)'''
URL = r"\A([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?\z"
STRIP = r"\A[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+\z"
WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
GUARD = r"https?://" + WS.replace("[", "[^", 1) + r"+|[#＃][\p{L}\p{N}_]+" + WS + "*"
DATE = r"[0-9]月|20\p{Nd}\p{Nd}|199\p{Nd}|平成|昭和|H[2-3][0-9]"
# Named references that occur in the tables; numeric ones are computed.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&", "copy": "©", "middot": "·", "eacute": "é", "mdash": "—"}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def decode(x: str) -> str:
    names = " ".join(f"WHEN starts_with(p, {q(k + ';')}) THEN {q(v)} || substr(p, {len(k) + 2})" for k, v in ENTITIES.items())
    return f"""array_to_string(list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p {names}
        WHEN regexp_matches(p, '^#[0-9]{{1,7}};') THEN chr(CAST(regexp_extract(p, '^#([0-9]+);', 1) AS INTEGER)) || regexp_extract(p, '^#[0-9]+;((?s).*)', 1)
        ELSE '&' || p END), '')"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP)}, '', 'g')"


def tag_text(x: str) -> str:
    return strip(decode(f"regexp_replace({x}, {q(ANY_TAG)}, '', 'g')"))


def sum_len(arr: str) -> str:
    inner = decode("regexp_replace(z, " + q(ANY_TAG) + ", '', 'g')")
    return f"coalesce(list_sum(list_transform({arr}, lambda z: length({inner}))), 0)"


def latin(x: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, '[a-zA-Z]', '', 'g')))"


def clean_ja(x: str) -> str:
    ja = strip(f"regexp_replace({strip(x)}, {q('[ 　' + chr(9) + ']')}, '', 'g')")
    for s in JA_SITE_SUFFIXES:
        ja = f"replace({ja}, {q(s)}, '')"
    en = strip(f"replace({x}, chr(9), ' ')")
    return f"(CASE WHEN {latin(x)} > floor(length({x}) / 2.0) THEN {en} ELSE {ja} END)"


def blocks_cte(table: str = "pages", key: str = "page_id") -> str:
    """CTEs ``toks`` (one row per raw block) and ``blk`` (block columns)."""
    marked = (f"regexp_replace(regexp_replace(html, {q(PRE_STRIP)}, '', 'g'), "
              f"{q(BLOCK_TAG)}, chr(1) || '\\0', 'g')")
    return f"""
toks0 AS (SELECT {key}, string_split({marked}, chr(1)) AS arr FROM {table}),
toks AS (SELECT {key}, unnest(arr) AS tok, unnest(range(len(arr))) AS pos FROM toks0),
blk AS (
  SELECT {key}, pos,
         lower(regexp_extract(tok, {q(TAG_NAME)}, 1)) AS tag,
         regexp_matches(tok, {q(LINK)}) AS is_link,
         {tag_text('tok')} AS text,
         {sum_len(f"regexp_extract_all(tok, {q(ANCHOR_TEXT)}, 1)")} AS a_len,
         {sum_len(f"regexp_extract_all(tok, {q(STRONG_TEXT)}, 1)")} AS strong_len
  FROM toks)"""


def heading_cte(key: str = "page_id") -> str:
    return f"""
head AS (
  SELECT {key}, CAST(substr(tag, 2, 1) AS INTEGER) AS heading_level, pos AS heading_pos, text AS main_heading
  FROM blk
  WHERE regexp_matches(tag, '^h[1-9]$') AND NOT is_link AND text <> ''
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY CAST(substr(tag, 2, 1) AS INTEGER), pos) = 1)"""


def features_cte(key: str = "page_id", table: str = "pages", max_p: int = 30, factor: float = 2) -> str:
    """CTE ``feat``: per-page features matching ``page_features``."""
    lang_case = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in REGION_LANG.items())
    title = tag_text(f"regexp_extract(p.html, {q(TITLE)}, 1)")
    return f"""
agg AS (
  SELECT {key},
         count(*) FILTER (WHERE text <> '' AND NOT is_link) AS content_num,
         count(*) FILTER (WHERE text <> '' AND is_link) AS link_num,
         coalesce(arg_min(text, pos) FILTER (WHERE tag = 'p'), '') AS first_par,
         coalesce(arg_min(text, pos) FILTER (WHERE tag = 'h1'), '') AS first_h1,
         count(*) FILTER (WHERE tag = 'li') AS n_li,
         count(*) FILTER (WHERE tag = 'li' AND is_link) AS n_li_a,
         coalesce(sum(length({clean_ja('text')})) FILTER (WHERE tag = 'p' AND NOT is_link), 0) AS p_len,
         string_agg(text, chr(10) ORDER BY pos) FILTER (WHERE text <> '' AND NOT is_link) AS ctext
  FROM blk GROUP BY {key}),
after AS (
  SELECT b.{key}, sum(b.a_len) AS a_after,
         sum(CASE WHEN b.tag = 'p' THEN length(b.text) ELSE 0 END + b.strong_len) AS p_after
  FROM blk b JOIN head h ON b.{key} = h.{key} AND b.pos > h.heading_pos
  GROUP BY b.{key}),
feat AS (
  SELECT p.{key}, p.url,
         {title} AS title,
         a.content_num, a.link_num, a.first_par, a.first_h1,
         h.heading_level, h.heading_pos, h.main_heading,
         (a.n_li > 0 AND a.p_len <= {max_p} AND a.n_li_a * 10 > a.n_li * 8) AS link_list,
         CASE WHEN h.heading_pos IS NULL THEN NULL
              WHEN coalesce(f.p_after, 0) = 0 THEN false
              ELSE coalesce(f.a_after, 0) > {factor} * f.p_after END AS link_dominated,
         concat_ws(chr(10), nullif({title}, ''), a.ctext) AS text,
         nullif(lower(regexp_extract(p.html, {q(HTML_LANG)}, 1)), '') AS html_lang,
         nullif(regexp_extract(regexp_extract(p.url, {q(URL)}, 3), '^/([^/]+)/', 1), '') AS region
  FROM {table} p JOIN agg a ON p.{key} = a.{key}
  LEFT JOIN head h ON p.{key} = h.{key}
  LEFT JOIN after f ON p.{key} = f.{key}),
feat2 AS (
  SELECT *, {norm_lang(f"coalesce(html_lang, CASE region {lang_case} END)")} AS src_lang,
         len(string_split(text, chr(10))) AS n_lines
  FROM feat)"""



def norm_lang(x: str) -> str:
    return f"(CASE WHEN contains(lower({x}), 'cn') THEN 'zh' ELSE lower({x}) END)"


def keyword_sql(x: str, keywords) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(k)})" for k in dict.fromkeys(keywords)) + ")"


def route_sql(src: str, to: str, routes=None) -> str:
    arms = " ".join(f"WHEN {q(t)} THEN [{', '.join(q(s) for s in srcs)}]" for t, srcs in (routes or ROUTE_SOURCES).items())
    return f"coalesce(list_contains(CASE {to} {arms} END, {src}), false)"


def status_sql(src: str, to: str, has_files: str, kw: str, content: str, links: str,
               n_lines: str, text_len: str, region: str | None = None, max_lines: int = 500,
               density: float = 0.2, routes=None) -> str:
    dens = f"(NOT (({content} + 1) / ({content} + {links} + 1) < {density})"
    dens += f" OR coalesce({region} = 'my', false))" if region else ")"
    return f"""(CASE WHEN {src} IS NULL OR NOT {route_sql(src, to, routes)} THEN 9
      WHEN NOT ({has_files}) THEN 4
      WHEN NOT ({kw}) THEN 1
      WHEN NOT {dens} THEN 2
      WHEN NOT coalesce({src} = {to}, false) AND {n_lines} > {max_lines} THEN 7
      WHEN {text_len} <= 1 THEN 3
      ELSE 0 END)"""


# --- token overlap (J6) -----------------------------------------------------
def _words(x):
    return f"list_distinct(list_filter(string_split_regex({x}, {q(WS + '+')}), lambda t: t <> ''))"


def _bigrams(x):
    s = f"regexp_replace({x}, {q(WS + '+')}, '', 'g')"
    return (f"list_distinct(list_filter(list_transform(range(1, greatest(length({s}) - 1, 1) + 1), "
            f"lambda i: substr({s}, i, 2)), lambda g: length(g) = 2))")


def _ov(a, b):
    m = f"least(len({a}), len({b}))"
    return f"(CASE WHEN {m} = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / {m} END)"


def text_overlap(x, y):
    both = f"({x} || {y})"
    alnum = f"(length({both}) - length(regexp_replace({both}, '[a-zA-Z0-9]', '', 'g')))"
    nonblank = f"length(replace({both}, ' ', ''))"
    return (f"(CASE WHEN {alnum} > floor({nonblank} / 2.0) THEN {_ov(_words(x), _words(y))} "
            f"ELSE {_ov(_bigrams(x), _bigrams(y))} END)")
