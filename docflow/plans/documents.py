"""Queries over ``documents`` (+ ``labels``): keywords, routing, status,
quota, ledgers, packing, translation, text cleaners."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow import constants as K
from docflow.functions import text as T
from docflow.operators import ledger as L
from docflow.operators.packing import explode_parts, pack
from docflow.operators.routing import normalize_lang, route_supported, text_status, with_targets
from docflow.operators.translate import translate_items
from docflow.plans import sqlparts as S
from docflow.plans.common import read

# Keyword list for status queries over the synthetic documents (the real
# list never occurs in them): frequent fragments in all four languages.
DOC_KEYWORDS = ["tion", "ein"]
TO_LANGS = ["ja", "en"]
# Limits under which the synthetic documents reach codes 0, 1, 7 and 9: the
# original's 500 lines never occur, and all four languages have routes.
DOC_MAX_LINES = 15
DOC_ROUTES = {"ja": ["en", "fr", "de"], "en": ["en", "fr", "es"]}
# Filter words of the synthetic prose, any case (the original's sample filter
# words never occur in it).
DOC_FILTER = ["the and", "pour", "nicht"]
# Class/term parameter for the keyword-class query (the original read its
# class keywords from a file): frequent fragments of the synthetic prose.
DOC_CLASSES = [("class_a", "tion"), ("class_b", "ein"), ("class_b", "sch"), ("class_c", "the"),
               ("class_d", "qu")]


def q_keyword_hits(spark, sf):
    """keyword flags with the original list, the sample list and
    the probe list."""
    d = read(spark, sf, "documents")
    return d.select("doc_id",
                    T.keyword_flag("text", K.COVID_KEYWORDS).alias("hit_default"),
                    T.keyword_flag("text", K.SAMPLE_FILTER_KEYWORDS).alias("hit_sample"),
                    T.keyword_flag("text", DOC_FILTER, ignore_case=True).alias("hit_filter"),
                    T.keyword_flag("text", DOC_KEYWORDS).alias("hit_terms"))


def q_lang_route(spark, sf):
    """P10 + J5 + P13: documents per (source language, target) and
    whether a route exists."""
    d = read(spark, sf, "documents").select(normalize_lang("lang").alias("src_lang"))
    t = with_targets(d, TO_LANGS)
    return (t.groupBy("src_lang", "to_lang").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("supported", route_supported("src_lang", "to_lang", DOC_ROUTES)))


def doc_status_rows(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    return text_status(d, TO_LANGS, DOC_KEYWORDS, max_lines=DOC_MAX_LINES, routes=DOC_ROUTES)


def q_doc_status(spark, sf):
    """F8 (F4, F7 included) for text items, per target and status."""
    return doc_status_rows(spark, sf).groupBy("to_lang", "status").agg(F.count(F.lit(1)).alias("n"))


def q_status_totals(spark, sf):
    """Status lines per source for the Japanese target."""
    d = read(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    s = text_status(d, ["ja"], DOC_KEYWORDS, max_lines=DOC_MAX_LINES, routes=DOC_ROUTES)
    return L.status_totals(s, ["source", "status"])


def q_site_quota(spark, sf):
    """A1: newest 10 documents per source (newest = highest doc_id)."""
    d = read(spark, sf, "documents").select("doc_id", "source")
    return L.site_quota(d, "source", [F.col("doc_id").desc()], K.TRANSLATE_SITE_QUOTA)


def q_backlog(spark, sf):
    """J1 + A3: documents not yet classified (labels is the classifier's
    ledger), per source and language."""
    d = read(spark, sf, "documents").select("doc_id", "source", "lang")
    lab = read(spark, sf, "labels").select("doc_id")
    return L.backlog(d, lab, "doc_id", ["source", "lang"])


def q_ready_set(spark, sf):
    """Translated to ja (status 0) and to en (status 0) and extracted
    (non-empty text), not yet classified; newest first."""
    st = doc_status_rows(spark, sf)
    ja = L.ok_items(st.filter(F.col("to_lang") == "ja"), "doc_id")
    en = L.ok_items(st.filter(F.col("to_lang") == "en"), "doc_id")
    ex = read(spark, sf, "documents").filter(F.length("text") > 0).select("doc_id")
    lab = read(spark, sf, "labels").select("doc_id")
    return L.ready_set(ja, en, ex, lab, "doc_id", order=[F.col("doc_id").desc()])


def q_chunks(spark, sf):
    """Parts of < 300 chars per document."""
    d = read(spark, sf, "documents").select("doc_id", "text")
    p = explode_parts(d, "doc_id")
    return p.select("doc_id", F.col("part_no").cast("long").alias("part_no"),
                    F.length("part").cast("long").alias("part_len"), F.md5("part").alias("part_md5"))


def q_translate_docs(spark, sf):
    """U1 + A8: status cascade, packing, distinct-part translation through
    the caller's function (pass-through here), re-assembly, status 3 check."""
    d = read(spark, sf, "documents").withColumn("parts", pack("text"))    # once a document, not once a target
    st = text_status(d, TO_LANGS, DOC_KEYWORDS, max_lines=DOC_MAX_LINES, routes=DOC_ROUTES)
    out = translate_items(st, "doc_id", parts="parts")
    return out.select("doc_id", "to_lang", "status", "n_parts", F.md5("translated").alias("text_md5"))


def q_text_flags(spark, sf):
    """F4, F9, F10, F11 per document."""
    d = read(spark, sf, "documents")
    return d.select("doc_id", T.line_count("text").cast("long").alias("n_lines"),
                    T.too_long("text", DOC_MAX_LINES).alias("too_long"),
                    T.mostly_latin("text").alias("mostly_latin"),
                    T.date_mention("text").alias("date_mention"),
                    T.link_word("text").alias("link_word"))


def q_clean_text(spark, sf):
    """The two cleaners."""
    d = read(spark, sf, "documents")
    ja, en = T.clean_ja("text"), T.clean_en("text")
    return d.select("doc_id", F.length(ja).cast("long").alias("ja_len"), F.md5(ja).alias("ja_md5"),
                    F.length(en).cast("long").alias("en_len"), F.md5(en).alias("en_md5"))


def q_guard_tags(spark, sf):
    """Guarded text and the newline runs at both ends.  The runs are
    those of the text without the words of its first and of its last line
    (no document begins or ends with a newline); every other text also gets
    a URL, built from its id, in front."""
    d = read(spark, sf, "documents")
    url = F.concat(F.lit("https://a.example/"), F.col("doc_id").cast("string"), F.lit("?x=#y "))
    g = T.guard_tags(F.when(F.col("doc_id") % 2 == 0, F.concat(url, "text")).otherwise(F.col("text")))
    rest = F.regexp_replace("text", r"\A[^\n]+", "")
    inner = F.substring(rest, F.lit(1), F.length(rest) - F.length(F.substring_index(rest, "\n", -1)))
    return d.select("doc_id", F.md5(g).alias("guarded_md5"),
                    F.length(T.leading_newlines(inner)).cast("long").alias("lead_nl"),
                    F.length(T.trailing_newlines(inner)).cast("long").alias("trail_nl"))


def q_doc_classes(spark, sf):
    """U2 keyword classification: the classes whose terms occur in each
    document (sorted, comma-joined)."""
    from docflow.operators.keywords import keyword_classes
    d = read(spark, sf, "documents").select("doc_id", "text")
    out = keyword_classes(d, "text", DOC_CLASSES)
    return out.select("doc_id", F.array_join("keyword_classes", ",").alias("classes"))


def q_html_render(spark, sf):
    """Text rendered as HTML, one <p> per line."""
    d = read(spark, sf, "documents")
    h = T.render_html("text")
    return d.select("doc_id", F.length(h).cast("long").alias("html_len"), F.md5(h).alias("html_md5"))


QUERIES = {
    "keyword_hits": q_keyword_hits, "lang_route": q_lang_route, "doc_status": q_doc_status,
    "status_totals": q_status_totals, "site_quota": q_site_quota, "backlog": q_backlog,
    "ready_set": q_ready_set, "chunks": q_chunks, "translate_docs": q_translate_docs,
    "text_flags": q_text_flags, "clean_text": q_clean_text, "guard_tags": q_guard_tags,
    "html_render": q_html_render, "doc_classes": q_doc_classes,
}

# ---------------------------------------------------------------- oracles
_q = S.q
_KW = S.keyword_sql
_NL = "chr(10)"
_LINES = f"len(string_split(text, {_NL}))"
_STATUS = S.status_sql("src_lang", "to_lang", "coalesce(length(text) > 0, false)",
                       f"coalesce({_KW('text', DOC_KEYWORDS)}, false)", "1", "0", _LINES, "length(text)",
                       max_lines=DOC_MAX_LINES, routes=DOC_ROUTES)
_DST = f"""
d AS (SELECT doc_id, source, text, {S.norm_lang('lang')} AS src_lang FROM documents),
t AS (SELECT d.*, v.to_lang FROM d, (VALUES ('ja'), ('en')) v(to_lang)),
st AS (SELECT t.*, {_STATUS} AS status FROM t)"""

_CHUNKS = f"""
lines AS (
  SELECT doc_id, unnest(string_split(text, {_NL})) AS line,
         unnest(range(len(string_split(text, {_NL})))) AS i
  FROM SRC),
walk(doc_id, i, cur, part) AS (
  SELECT doc_id, i, length(line) + 1, CASE WHEN length(line) + 1 < {K.PART_LIMIT} THEN 0 ELSE 1 END
  FROM lines WHERE i = 0
  UNION ALL
  SELECT l.doc_id, l.i,
         CASE WHEN w.cur + length(l.line) + 1 < {K.PART_LIMIT} THEN w.cur + length(l.line) + 1 ELSE length(l.line) + 1 END,
         CASE WHEN w.cur + length(l.line) + 1 < {K.PART_LIMIT} THEN w.part ELSE w.part + 1 END
  FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.i = w.i + 1),
raw_parts AS (
  SELECT w.doc_id, w.part, {S.strip(f"string_agg(l.line || {_NL}, '' ORDER BY l.i)")} AS txt
  FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.i = w.i
  GROUP BY w.doc_id, w.part),
parts AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part) - 1 AS part_no, txt
  FROM raw_parts WHERE txt <> '')"""


def _ml(x):
    t = S.strip(f"regexp_replace({x}, '[　 ' || chr(9) || ']', '', 'g')")
    head = f"substr({t}, 1, 200)"
    return f"(CASE WHEN length({t}) < 200 THEN false ELSE {S.latin(head)} * 10 > length({head}) * 6 END)"


_ROUTE_VALUES = ", ".join(f"({_q(s)}, {_q(t)})" for t, srcs in DOC_ROUTES.items() for s in srcs)

SQL = {
    "keyword_hits": f"""SELECT doc_id, {_KW('text', K.COVID_KEYWORDS)} AS hit_default,
        {_KW('text', K.SAMPLE_FILTER_KEYWORDS)} AS hit_sample, {_KW('lower(text)', DOC_FILTER)} AS hit_filter,
        {_KW('text', DOC_KEYWORDS)} AS hit_terms
        FROM documents""",
    "lang_route": f"""WITH r(from_lang, to_lang) AS (VALUES {_ROUTE_VALUES}),
        d AS (SELECT {S.norm_lang('lang')} AS src_lang FROM documents),
        t AS (SELECT d.src_lang, v.to_lang FROM d, (VALUES ('ja'), ('en')) v(to_lang))
        SELECT t.src_lang, t.to_lang, count(*) AS n,
               bool_or(r.from_lang IS NOT NULL) AS supported
        FROM t LEFT JOIN r ON r.from_lang = t.src_lang AND r.to_lang = t.to_lang
        GROUP BY t.src_lang, t.to_lang""",
    "doc_status": f"WITH {_DST} SELECT to_lang, status, count(*) AS n FROM st GROUP BY ALL",
    "status_totals": f"WITH {_DST} SELECT source, status, count(*) AS n FROM st WHERE to_lang = 'ja' GROUP BY ALL",
    "site_quota": f"""SELECT doc_id, source, rank FROM (
        SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rank
        FROM documents) WHERE rank <= {K.TRANSLATE_SITE_QUOTA}""",
    "backlog": """SELECT source, lang, count(*) AS n FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY ALL""",
    "ready_set": f"""WITH {_DST}
        SELECT doc_id FROM st WHERE to_lang = 'ja' AND status = 0
        INTERSECT SELECT doc_id FROM st WHERE to_lang = 'en' AND status = 0
        INTERSECT SELECT doc_id FROM documents WHERE length(text) > 0
        EXCEPT SELECT doc_id FROM labels""",
    "chunks": "WITH RECURSIVE " + _CHUNKS.replace("SRC", "documents")
              + " SELECT doc_id, part_no, length(txt) AS part_len, md5(txt) AS part_md5 FROM parts",
    "translate_docs": "WITH RECURSIVE " + _DST + ", todo AS (SELECT * FROM st WHERE status = 0 AND src_lang <> to_lang)"
              + ", " + _CHUNKS.replace("SRC", "(SELECT DISTINCT doc_id, text FROM todo)") + f""",
        joined AS (SELECT doc_id, count(*) AS n_parts, string_agg(txt, {_NL} ORDER BY part_no) AS tx
                   FROM parts GROUP BY doc_id),
        tr AS (SELECT t.doc_id, t.to_lang, coalesce(j.n_parts, 0) AS n_parts, coalesce(j.tx, '') AS tx
               FROM todo t LEFT JOIN joined j ON t.doc_id = j.doc_id
               UNION ALL
               SELECT doc_id, to_lang, NULL, text FROM st WHERE status = 0 AND src_lang = to_lang)
        SELECT doc_id, to_lang, CASE WHEN length(tx) <= 1 THEN 3 ELSE 0 END AS status,
               n_parts, md5(tx) AS text_md5 FROM tr
        UNION ALL
        SELECT doc_id, to_lang, status, NULL, NULL FROM st WHERE status <> 0""",
    "text_flags": f"""SELECT doc_id, {_LINES} AS n_lines, {_LINES} > {DOC_MAX_LINES} AS too_long,
        {_ml('text')} AS mostly_latin, regexp_matches(text, {_q(S.DATE)}) AS date_mention,
        contains(text, {_q(K.LINK_WORD)}) AS link_word FROM documents""",
    "clean_text": f"""SELECT doc_id, length({S.clean_ja('text')}) AS ja_len, md5({S.clean_ja('text')}) AS ja_md5,
        length({S.strip("replace(text, chr(9), ' ')")}) AS en_len,
        md5({S.strip("replace(text, chr(9), ' ')")}) AS en_md5 FROM documents""",
    "guard_tags": r"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'https://a.example/' || doc_id || '?x=#y ' || text ELSE text END AS text,
               regexp_replace(regexp_replace(text, '\A[^\n]+', ''), '[^\n]+\z', '') AS i FROM documents)
        SELECT doc_id, md5(regexp_replace(text, GUARD, ' ｟\0 ｠ ', 'g')) AS guarded_md5,
        length(regexp_extract(i, '\A(\n*)', 1)) AS lead_nl,
        length(regexp_extract(regexp_replace(i, '\A\n*', ''), '(\n*)\z', 1)) AS trail_nl FROM t""".replace("GUARD", _q(S.GUARD)),
    "html_render": f"""WITH h AS (SELECT doc_id, '<html>' || chr(10) || '<head><meta charset="utf-8"/></head>' || chr(10) || '<body>' || chr(10) || array_to_string(list_transform(
            string_split(text, {_NL}), lambda l: '<p>' || l || '</p>' || {_NL}), '') || '</body>' || chr(10) || '</html>' || chr(10) AS html
            FROM documents)
        SELECT doc_id, length(html) AS html_len, md5(html) AS html_md5 FROM h""",
    "doc_classes": "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(["
                   + ", ".join(f"CASE WHEN contains(text, {_q(t)}) THEN {_q(c)} END" for c, t in DOC_CLASSES)
                   + "], lambda x: x IS NOT NULL))), ',') AS classes FROM documents",
}
