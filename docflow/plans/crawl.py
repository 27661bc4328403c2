"""Queries over crawl paths, manifests, ledgers, sidecars and the keyword
dictionary (P1-P9, P11, S3, S5, S6, S8, S10-S12, J3, J8, X11, F5, K1-K4, K9, W2, W4, U1).
The given tables have no such files, so each query first writes the rows out
in the file's form (a path, a meta line, a block XML, a JSON line) and then
reads them back with the operator; the oracle computes the same from the rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from docflow import constants as K
from docflow.functions import paths as P
from docflow.functions.text import escape_html
from docflow.operators import ledger as L
from docflow.operators.keywords import hits_per_lang
from docflow.operators.packing import explode_parts
from docflow.operators.routing import normalize_lang
from docflow.operators.translate import dictionary_translator, translate_items
from docflow.plans.common import read
from docflow.plans.documents import _CHUNKS
from docflow.plans.sqlparts import norm_lang, q
from docflow.session import scratch_path
from docflow.sinks import tables as T
from docflow.sources import files as S
from docflow.sources import manifests as M
from docflow.streaming.incremental import dedupe_stream, file_stream, read_output, upsert_history

ROOT = "/crawl"


def crawl_paths(spark, sf):
    """Pages with a crawl path made of URL and id; every tenth is too short."""
    p = read(spark, sf, "pages", heavy=False).select("page_id", "url")
    n = lambda m, k: F.lpad((F.col("page_id") % m + k).cast("string"), 2, "0")
    folder = F.regexp_extract(P.url_path("url"), r"\A/([^/]+)/", 1)
    good = F.concat(F.lit(f"{ROOT}/"), folder, F.lit("/orig/"), P.url_host("url"), F.lit("/news/a b/2024/"), n(12, 1), F.lit("/"),
                    n(28, 1), F.lit("-"), n(24, 0), F.lit("-"), n(60, 0), F.lit("/p."), F.col("page_id").cast("string"), F.lit(".html"))
    short = F.concat(F.lit(f"{ROOT}/"), folder, F.lit("/x.html"))
    return p.withColumn("page_path", F.when(F.col("page_id") % 10 == 9, short).otherwise(good))


def q_crawl_paths(spark, sf):
    """Stage mapping, parts, keys and times."""
    parts = P.page_parts("page_path", ROOT, "Asia/Tokyo")
    df = crawl_paths(spark, sf).withColumn("p", parts)
    return df.select("page_id", P.stage_path("page_path", "orig", "ja_translated", ".txt").alias("target"), P.region_of("page_path", ROOT).alias("region"),
                     P.site_of("page_path", ROOT).alias("site"), F.col("p.path").alias("path"), F.col("p.filename").alias("filename"), F.col("p.record_id").alias("record_id"),
                     F.col("p.ts_local").alias("ts_local"), F.col("p.ts_utc").alias("ts_utc"), P.feature_key("page_path", ROOT).alias("feature"),
                     P.feature_key("page_path", ROOT, legacy=True).alias("legacy_feature"), P.crawl_time_key("page_path").alias("time_key"))


def q_post_paths(spark, sf):
    """Post paths and relative paths of the events, ISO times."""
    e = read(spark, sf, "events").select("event_id", "ts")
    path = F.concat(F.lit("/tw/us/orig/"), F.date_format("ts", "yyyy/MM/dd/HH-mm/"), F.col("event_id").cast("string"), F.lit(".json"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    e = e.withColumn("path", path).withColumn("p", P.tweet_parts("path", "/tw")).withColumn("rel", P.absolute_to_relative("path", "/tw"))
    return e.select("event_id", F.col("p.country").alias("country"), F.col("p.record_id").alias("record_id"), F.col("p.ts_utc").alias("ts_minute"),
                    P.parse_iso(iso).alias("ts_second"), "rel", (P.relative_to_absolute("rel", "/tw") == F.col("path")).alias("round_trip"))


MANIFEST_LINES = 50_000  # lines of a manifest at most, on average


def event_manifests(e, n_events):
    """Manifests with a line for each event: (file_name, value).  The lines of
    a day are dealt to files by a hash, and the files' number follows that of
    all events, so a manifest stays small even if all are of one day."""
    n_files = max(1, -(-n_events // MANIFEST_LINES))
    region = F.when(F.col("event_id") % 3 == 0, "us").when(F.col("event_id") % 3 == 1, "jp").otherwise("xx")
    line = F.concat(F.lit(f" {ROOT}/"), region, F.lit("/orig/"), F.col("event_type"), F.lit("/n/"), F.col("event_id").cast("string"), F.lit(".html "))
    day = F.date_format("ts", "yyyy-MM-dd")
    number = F.pmod(F.xxhash64("event_id", "ts"), F.lit(n_files)).cast("string")
    return e.groupBy(F.concat(F.lit("new-"), day, F.lit("-00."), number, F.lit(".txt")).alias("file_name")).agg(
        F.array_join(F.sort_array(F.collect_list(line)), "\n\n").alias("value"))


def q_manifest_window(spark, sf):
    """Manifests of the last weeks of events, with a line for each
    event, read back for a window of 10 days and one region."""
    e = read(spark, sf, "events").select("event_id", "ts", "event_type")
    newest, n_events = e.agg(F.max("ts"), F.count(F.lit(1))).first()
    last = newest.date() if newest else dt.date(1970, 1, 1)
    files = event_manifests(e, n_events)
    got = M.recent_lines(M.parse_manifests(files), 10, ROOT, "us", last)
    return got.select("page_path", F.col("file_date").cast("string").alias("file_date"), "region", "site", F.col("ordinal.age_days").cast("long").alias("age_days"))


def q_ledger_lines(spark, sf):
    """Text ledgers of the labels, read under each grammar."""
    lab = read(spark, sf, "labels")
    path = F.concat(F.lit("/p/"), F.col("doc_id").cast("string"))
    bad = F.col("doc_id") % 7 == 3
    out = []
    for grammar, line in (("three", F.concat_ws(" ", path, F.lit("dom"), F.when(~bad, F.col("toxic").cast("string")))),
                          ("first", F.concat(F.lit("  "), path, F.lit("\t"), F.when(bad, "x").otherwise(F.col("quality").cast("string")))),
                          ("line", F.concat(path, F.when(bad, " with blank").otherwise("")))):
        d = scratch_path(spark, f"ledgers/{grammar}-{uuid.uuid4().hex}")
        lab.select(line.alias("value")).write.text(d)
        out.append(M.read_ledger(spark, d, grammar, stage=grammar))
    return L.union_all(out).select("stage", "page_path", "domain", "status")


def q_meta_lines(spark, sf):
    """One-line meta records of the documents, a seventh of them
    damaged, joined back as sidecars."""
    d = read(spark, sf, "documents").select("doc_id", "source", "n_chars")
    line = F.concat_ws(" ", F.lit("0"), (F.col("doc_id") + 0.5).cast("string"), "source", F.col("n_chars").cast("string"), (F.col("doc_id") % 5).cast("string"),
                       F.when(F.col("doc_id") % 2 == 0, "True").otherwise("False"))
    line = F.when(F.col("doc_id") % 7 == 2, F.concat(line, F.lit(" more"))).when(F.col("doc_id") % 7 == 4, F.replace(line, F.col("n_chars").cast("string"), F.lit("n"))).otherwise(line)
    side = d.filter("doc_id % 11 <> 0").select(F.col("doc_id").alias("key"), F.concat(line, F.lit("\nsecond line")).alias("meta_line"))
    got = S.with_sidecars(d.select("doc_id", F.col("doc_id").alias("key")), {"meta_line": side}).drop("key")
    m = S.parse_meta("meta_line")
    return got.select("doc_id", S.all_present("meta_line").alias("present"), m["mtime"].alias("mtime"), m["domain"].alias("domain"),
                      m["content_num"].alias("content_num"), m["link_num"].alias("link_num"), m["keyword_flag"].alias("keyword_flag"))


def q_block_xml(spark, sf):
    """Block XML of the documents (a title, then a block a line, every
    third of them a link block), parsed."""
    d = read(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    block = lambda x, i: F.concat(F.lit('<S BlockType="'), F.when(i % 3 == 2, "Link").otherwise(K.CONTENT_BLOCK_TYPES[0]), F.lit('"><RawString>'), escape_html(x), F.lit("</RawString></S>"))
    xml = F.concat(F.lit("<Page><Title><RawString>T"), F.col("doc_id").cast("string"), F.lit("</RawString></Title>"), F.array_join(F.transform("lines", block), ""), F.lit("</Page>"))
    got = d.select("doc_id", S.parse_block_xml(xml).alias("b"))
    return got.select("doc_id", F.col("b.title").alias("title"), F.col("b.content_num").alias("content_num"), F.col("b.link_num").alias("link_num"), F.md5("b.text").alias("text_md5"))


def q_classified_jsonl(spark, sf):
    """Classified records of the labels as JSON lines, some
    broken, read back, minus those whose link a ledger holds."""
    lab = read(spark, sf, "labels").select("doc_id", "quality")
    file = F.concat(F.lit("us/orig/"), F.col("doc_id").cast("string"), F.lit(".html"))
    line = F.to_json(F.struct(F.struct(file.alias("file")).alias("orig"), F.struct(F.concat(F.lit('题 "'), F.col("doc_id").cast("string")).alias("title")).alias("ja_translated")))
    line = F.when(F.col("doc_id") % 9 == 1, F.substring(line, 1, 20)).otherwise(line)
    d = scratch_path(spark, f"jsonl/{uuid.uuid4().hex}")
    lab.select(line.alias("value")).write.text(d)
    view = S.classified_view(S.read_jsonl(spark, d), ROOT)
    done = lab.filter("quality = 0").select(F.concat(F.lit(f"{ROOT}/"), file).alias("page_path"))
    return L.unscored_records(view, done).select("link", "title")


STAGE_CHARS = 600    # shorter documents go to the quarantine table


def q_stage_tables(spark, sf):
    """The documents go through the stage tables in three
    batches, the second of them twice (as after a crash): extracted texts,
    their rendered HTML, a JSON line each, ledger lines, and a quarantine for
    short texts.  One row a ledger line, with what the tables hold for it."""
    d = read(spark, sf, "documents").select("doc_id", "lang", "text")
    d = d.withColumn("status", F.when(F.coalesce(F.length("text"), F.lit(0)) >= STAGE_CHARS, K.STATUS_OK).otherwise(K.STATUS_SHORT))
    root = scratch_path(spark, f"stages/{uuid.uuid4().hex}")
    for batch in (0, 1, 1, 2):
        rows = d.filter(F.pmod("doc_id", F.lit(3)) == batch)
        good = rows.filter(F.col("status") == K.STATUS_OK)
        T.write_extracted(good.select("doc_id", F.col("lang").alias("region"), F.md5("text").alias("text_md5")), f"{root}/extracted", batch)
        T.write_translated(good.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "ja").otherwise("en").alias("to_lang"), F.col("text").alias("translated")), f"{root}/translated", batch_id=batch)
        T.quarantine(rows.filter(F.col("status") != K.STATUS_OK), f"{root}/quarantine", "extract", "doc_id", F.concat(F.lit("status "), F.col("status").cast("string")), batch)
        T.append_ledger(rows, f"{root}/ledger", "extract", "doc_id", batch_id=batch)
    T.write_jsonl(d.select("doc_id", F.concat(F.lit('题 "'), "lang").alias("title")), f"{root}/jsonl")
    held = lambda name, ddl: spark.read.schema(ddl).parquet(f"{root}/{name}")
    out = held("ledger", "page_path long, status int, stage string, day date, batch_id long").select(F.col("page_path").alias("doc_id"), "stage", "status", "batch_id")
    json = S.read_jsonl(spark, f"{root}/jsonl").select(F.variant_get("record", "$.doc_id", "long").alias("doc_id"), F.try_variant_get("record", "$.title", "string").alias("title"))
    for side in (held("extracted", "doc_id long, text_md5 string, region string, batch_id long").drop("batch_id"),
                 held("translated", "doc_id long, html string, to_lang string").select("doc_id", "to_lang", F.md5("html").alias("html_md5")),
                 held("quarantine", "item long, reason string").select(F.col("item").alias("doc_id"), "reason"), json):
        out = out.join(side, "doc_id", "left")
    return out


def q_dictionary_hits(spark, sf):
    """Terms (the first words of the benchmark items, in two
    languages) found in each document."""
    words = F.split("text", " ")
    terms = read(spark, sf, "benchmark", heavy=False).select(F.col("item_id").alias("term_id"), F.when(F.col("item_id") % 2 == 0, "en").otherwise("fr").alias("lang"),
                                                             F.lower(F.element_at(words, 1)).alias("term"))
    out = hits_per_lang(read(spark, sf, "documents").select("doc_id", "text"), "text", terms, langs=["en", "fr"])
    return out.select("doc_id", F.col("hits_en").cast("long").alias("hits_en"), F.col("hits_fr").cast("long").alias("hits_fr"), F.size("kw_found").cast("long").alias("n_found"))


def q_dedupe_stream(spark, sf):
    """Users of the event stream, each once within the watermark."""
    base = scratch_path(spark, f"streams/dedupe-{uuid.uuid4().hex}")
    schema = read(spark, sf, "events").schema
    s = file_stream(spark, f"{sf}/events.parquet*", schema).select("user_id", "ts")
    upsert_history(dedupe_stream(s, "user_id", "ts", "3650 days").select("user_id"), f"{base}/out", f"{base}/ckpt")
    return read_output(spark, f"{base}/out", s.select("user_id").schema).select("user_id")


TM_TERMS = [("en", "ja", "the", "ザ"), ("fr", "ja", "la", "ラ"), ("de", "ja", "der", "デア")]


def q_translate_tm(spark, sf):
    """U1 with a dictionary and a translation memory: the parts of every third
    document are in the memory (marked), others go through the terms."""
    d = read(spark, sf, "documents").select("doc_id", normalize_lang("lang").alias("src_lang"), F.lit("ja").alias("to_lang"), F.lit(0).alias("status"), "text")
    mem = explode_parts(d.filter("doc_id % 3 = 0"), "doc_id", keep=["src_lang"]).select(
        F.col("src_lang").alias("from_lang"), F.lit("ja").alias("to_lang"), "part", F.concat(F.lit("M:"), "part").alias("translated"))
    out = translate_items(d, "doc_id", translate_fn=dictionary_translator(TM_TERMS), memory=mem)
    return out.select("doc_id", "status", "n_parts", F.md5("translated").alias("text_md5"))


QUERIES = {"crawl_paths": q_crawl_paths, "post_paths": q_post_paths, "manifest_window": q_manifest_window, "ledger_lines": q_ledger_lines, "meta_lines": q_meta_lines,
           "block_xml": q_block_xml, "classified_jsonl": q_classified_jsonl, "stage_tables": q_stage_tables, "dictionary_hits": q_dictionary_hits, "dedupe_stream": q_dedupe_stream, "translate_tm": q_translate_tm}

# ---------------------------------------------------------------- oracles
_REGIONS = ", ".join(q(r) for r in K.REGIONS)
_CASES = " ".join(f"WHEN src_lang = '{f}' THEN replace(txt, '{a}', '{b}')" for f, _, a, b in TM_TERMS)

SQL = {
    "crawl_paths": f"""
        WITH u AS (SELECT page_id, page_id % 10 = 9 AS short, split_part(split_part(url, '://', 2), '/', 2) AS folder,
            lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS host,
            make_timestamp(2024, page_id % 12 + 1, page_id % 28 + 1, page_id % 24, page_id % 60, 0) AS ts FROM pages),
        v AS (SELECT *, strftime(ts, '/%Y/%m/%d-%H-%M/') AS w FROM u)
        SELECT page_id, CASE WHEN short THEN '/crawl/' || folder || '/x.txt' ELSE '/crawl/' || folder || '/ja_translated/' || host || '/news/a b' || w || 'p.' || page_id || '.txt' END AS target,
            CASE WHEN folder IN ({_REGIONS}) THEN folder END AS region, CASE WHEN NOT short THEN host END AS site, CASE WHEN NOT short THEN 'news/a b' END AS path,
            CASE WHEN NOT short THEN 'p.' || page_id || '.' END AS filename, CASE WHEN NOT short THEN folder || '/' || host || '/news/a b/p.' || page_id || '.' END AS record_id,
            CASE WHEN NOT short THEN ts END AS ts_local, CASE WHEN NOT short THEN ts - INTERVAL 9 HOURS END AS ts_utc,
            CASE WHEN NOT short THEN folder || '/' || host || '/news/a b' || w || 'p.' || page_id END AS feature,
            CASE WHEN short THEN '' ELSE 'news/a b' || w || 'p.' || page_id || '.' END AS legacy_feature,
            CASE WHEN NOT short THEN -CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) END AS time_key FROM v""",
    "post_paths": """SELECT event_id, 'us' AS country, event_id || '.' AS record_id, date_trunc('minute', ts) AS ts_minute, date_trunc('second', ts) AS ts_second,
        './us/orig/' || strftime(ts, '%Y/%m/%d/%H-%M/') || event_id || '.json' AS rel, true AS round_trip FROM events""",
    "manifest_window": """WITH m AS (SELECT max(CAST(ts AS DATE)) AS last FROM events)
        SELECT '/crawl/us/orig/' || event_type || '/n/' || event_id || '.html' AS page_path, CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date, 'us' AS region, event_type AS site,
               last - CAST(ts AS DATE) AS age_days FROM events, m WHERE event_id % 3 = 0 AND CAST(ts AS DATE) > last - 10""",
    "ledger_lines": """
        SELECT 'three' AS stage, '/p/' || doc_id AS page_path, 'dom' AS domain, CAST(toxic AS INTEGER) AS status FROM labels WHERE doc_id % 7 <> 3
        UNION ALL SELECT 'first', '/p/' || doc_id, NULL, CASE WHEN doc_id % 7 <> 3 THEN CAST(quality AS INTEGER) END FROM labels
        UNION ALL SELECT 'line', '/p/' || doc_id || CASE WHEN doc_id % 7 = 3 THEN ' with blank' ELSE '' END, NULL, NULL FROM labels""",
    "meta_lines": """WITH d AS (SELECT *, doc_id % 11 <> 0 AS present, doc_id % 11 <> 0 AND doc_id % 7 NOT IN (2, 4) AS good FROM documents)
        SELECT doc_id, present, CASE WHEN good THEN doc_id + 0.5::DOUBLE END AS mtime, CASE WHEN good THEN source END AS domain,
               CASE WHEN good THEN CAST(n_chars AS INTEGER) END AS content_num, CASE WHEN good THEN CAST(doc_id % 5 AS INTEGER) END AS link_num,
               CASE WHEN good THEN doc_id % 2 = 0 END AS keyword_flag FROM d""",
    "block_xml": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
        SELECT doc_id, 'T' || doc_id AS title, CAST(count(*) FILTER (WHERE i % 3 <> 2) AS INTEGER) AS content_num, CAST(count(*) FILTER (WHERE i % 3 = 2) AS INTEGER) AS link_num,
               md5('T' || doc_id || coalesce(string_agg(chr(10) || x, '' ORDER BY i) FILTER (WHERE i % 3 <> 2 AND x <> ''), '')) AS text_md5 FROM l GROUP BY doc_id""",
    "stage_tables": f"""WITH d AS (SELECT *, coalesce(length(text), 0) >= {STAGE_CHARS} AS good,
            '<html>' || chr(10) || '<head><meta charset="utf-8"/></head>' || chr(10) || '<body>' || chr(10) || array_to_string(list_transform(
            string_split(text, chr(10)), lambda l: '<p>' || l || '</p>' || chr(10)), '') || '</body>' || chr(10) || '</html>' || chr(10) AS html FROM documents)
        SELECT doc_id, 'extract' AS stage, CASE WHEN good THEN 0 ELSE 3 END AS status, doc_id % 3 AS batch_id,
               CASE WHEN good THEN md5(text) END AS text_md5, CASE WHEN good THEN lang END AS region,
               CASE WHEN good THEN CASE WHEN doc_id % 2 = 0 THEN 'ja' ELSE 'en' END END AS to_lang, CASE WHEN good THEN md5(html) END AS html_md5,
               CASE WHEN NOT good THEN 'status 3' END AS reason, '题 "' || lang AS title FROM d""",
    "classified_jsonl": """SELECT '/crawl/us/orig/' || doc_id || '.html' AS link, '题 "' || doc_id AS title FROM labels WHERE doc_id % 9 <> 1 AND quality <> 0""",
    "dictionary_hits": """WITH t AS (SELECT item_id % 2 = 0 AS en, lower(split_part(text, ' ', 1)) AS term FROM benchmark)
        SELECT doc_id, count(*) FILTER (WHERE en AND contains(text, term)) AS hits_en, count(*) FILTER (WHERE NOT en AND contains(text, term)) AS hits_fr,
               count(*) FILTER (WHERE contains(text, term)) AS n_found FROM documents, t GROUP BY doc_id""",
    "dedupe_stream": "SELECT DISTINCT user_id FROM events",
    "translate_tm": "WITH RECURSIVE st AS (SELECT doc_id, text, " + norm_lang("lang") + " AS src_lang FROM documents), " + _CHUNKS.replace("SRC", "st") + f""",
        p AS (SELECT parts.*, src_lang FROM parts JOIN st USING (doc_id)),
        m AS (SELECT DISTINCT src_lang, txt FROM p WHERE doc_id % 3 = 0),
        t AS (SELECT p.doc_id, part_no, CASE WHEN m.txt IS NOT NULL THEN 'M:' || p.txt ELSE x.y END AS y FROM p LEFT JOIN m USING (src_lang, txt)
              JOIN (SELECT doc_id, part_no, CASE {_CASES} ELSE txt END AS y FROM p) x USING (doc_id, part_no)),
        j AS (SELECT doc_id, count(*) AS n_parts, string_agg(y, chr(10) ORDER BY part_no) AS y FROM t GROUP BY doc_id)
        SELECT doc_id, CASE WHEN length(coalesce(y, '')) <= 1 THEN 3 ELSE 0 END AS status, coalesce(n_parts, 0) AS n_parts, md5(coalesce(y, '')) AS text_md5
        FROM documents LEFT JOIN j USING (doc_id)""",
}
