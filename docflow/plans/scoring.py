"""Scoring queries (U2, U3, U4) with one-pass models, which SQL restates."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.text import keyword_flag, line_count
from docflow.operators import scoring as M
from docflow.operators.pages import page_features
from docflow.operators.routing import normalize_lang, route_supported
from docflow.plans.common import read
from docflow.plans.documents import DOC_KEYWORDS
from docflow.plans.sqlparts import blocks_cte, features_cte, heading_cte, keyword_sql

#: Parameters under which the enrich chain has rows that fail each check.
ENRICH_ROUTES = {"ja": ["en", "fr", "de"]}
ENRICH_LINES = 30


def q_topic_score(spark, sf):
    """Nearest class centroid over the embeddings, one class per row."""
    emb = read(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    out = M.nearest_centroid(emb, "embedding", M.class_centroids(emb, "embedding", "label"))
    return out.select("vec_id", "label", F.col("topic").cast("int").alias("topic"), F.round("confidence", 4).alias("confidence"))


def _binned(spark, sf):
    """Documents with their bins, and the model of labels.quality."""
    d = read(spark, sf, "documents").select("doc_id", "text", "lang")
    bins = M.text_bins("text")
    table = d.select("doc_id", "lang", line_count("text").alias("n_lines"), keyword_flag("text", DOC_KEYWORDS).alias("hit"), *[c.alias(f) for f, c in bins.items()])
    cols = {f: F.col(f) for f in bins}
    lab = read(spark, sf, "labels").select("doc_id", "quality")
    return table, cols, M.fit_bins(table.join(lab, "doc_id"), "quality", cols)


def q_quality_score(spark, sf):
    """U2 over text: quality trained on labelled documents, for every document."""
    table, cols, model = _binned(spark, sf)
    return table.select("doc_id", F.round(M.score_bins(model, cols), 6).alias("score"))


def q_sentiment(spark, sf):
    """Score of each page's title, -1 when there is none; word means
    learned from the pages that a label names by id."""
    t = page_features(read(spark, sf, "pages"), url=None, features=["title"]).select("page_id", "title")
    lab = read(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), "quality")
    means = M.word_means(t.join(lab, "page_id"), "title", "quality")
    return M.mean_sentiment(t, "page_id", "title", means).select("page_id", F.round("sentiment", 6).alias("sentiment"))


def q_enrich_docs(spark, sf):
    """U4: metadata -> text -> keyword class -> topic, each checked; a
    failed row gets status 1 and no record."""
    table, cols, model = _binned(spark, sf)
    steps = [
        ("metadata", lambda x: x.withColumn("src_lang", normalize_lang("lang")), route_supported("src_lang", F.lit("ja"), ENRICH_ROUTES)),
        ("text", lambda x: x, F.col("n_lines") <= ENRICH_LINES),
        ("keywords", lambda x: x.withColumn("keyword_class", F.when(F.col("hit"), F.lit(1))), F.col("keyword_class").isNotNull()),
        ("topic", lambda x: x.withColumn("topic_score", M.score_bins(model, cols)), F.col("topic_score") >= 0.5),
    ]
    out = M.enrich(table, steps)
    record = lambda c: F.when(F.col("status") == 0, c)
    return out.select("doc_id", "status", record(F.col("keyword_class")).alias("keyword_class"), record(F.round("topic_score", 6)).alias("topic_score"))


QUERIES = {"topic_score": q_topic_score, "quality_score": q_quality_score,
           "sentiment": q_sentiment, "enrich_docs": q_enrich_docs}

# ---------------------------------------------------------------- oracles
_T = "coalesce(text, '')"


def _share(cls: str, n: int) -> str:
    return f"CAST(floor((length({_T}) - length(regexp_replace({_T}, '{cls}', '', 'g'))) * {n} / greatest(length({_T}), 1)) AS INTEGER)"


_BINS = f"""
x AS (SELECT doc_id, text, lang, CAST(least(floor(length({_T}) / 500), 20) AS INTEGER) AS size, {_share('[A-Z]', 20)} AS capitals,
      {_share('[#$%&*!|]', 50)} AS marks, {_share(' ', 50)} AS blanks FROM documents),
f AS (SELECT doc_id, unnest(['size', 'capitals', 'marks', 'blanks']) AS f, unnest([size, capitals, marks, blanks]) AS b FROM x),
n AS (SELECT count(*) FILTER (WHERE quality > 0) AS n1, count(*) FILTER (WHERE quality <= 0) AS n0 FROM labels SEMI JOIN documents USING (doc_id)),
c AS (SELECT f, b, count(*) FILTER (WHERE quality > 0) AS c1, count(*) FILTER (WHERE quality <= 0) AS c0 FROM f JOIN labels USING (doc_id) GROUP BY f, b),
o AS (SELECT f, b, ln((c1 + 1) / (n1 + 51)) - ln((c0 + 1) / (n0 + 51)) AS odds FROM c, n),
z AS (SELECT doc_id, coalesce(sum(odds), 0) AS z FROM f LEFT JOIN o USING (f, b) GROUP BY doc_id),
s AS (SELECT doc_id, 1 / (1 + exp(-(z + ln((n1 + 1) / (n0 + 1))))) AS p FROM z, n)"""

SQL = {
    "topic_score": """
        WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, round(CAST(unnest(embedding) AS DOUBLE) * 1000000) AS x FROM embeddings),
        c AS (SELECT label AS c, i, sum(CAST(x AS BIGINT)) / count(*) AS m FROM e WHERE label IS NOT NULL GROUP BY ALL),
        d AS (SELECT vec_id, c, sum((x - m) * (x - m)) AS d FROM e JOIN c USING (i) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS r FROM d),
        t AS (SELECT vec_id, max(c) FILTER (WHERE r = 1) AS topic, max(d) FILTER (WHERE r = 1) AS d1, max(d) FILTER (WHERE r = 2) AS d2 FROM r GROUP BY vec_id)
        SELECT vec_id, label, CAST(topic AS INTEGER) AS topic, round(coalesce(CASE WHEN d1 + d2 > 0 THEN d2 / (d1 + d2) END, 1.0), 4) AS confidence
        FROM t JOIN embeddings USING (vec_id)""",
    "quality_score": f"WITH {_BINS} SELECT doc_id, round(p, 6) AS score FROM s",
    "sentiment": f"""
        WITH {blocks_cte()}, {heading_cte()}, {features_cte()},
        w AS (SELECT page_id, unnest(list_filter(string_split(lower(title), ' '), lambda w: w <> '')) AS word FROM feat),
        m AS (SELECT word, sum(quality) / count(*) AS mean FROM w JOIN labels ON doc_id = page_id GROUP BY word),
        s AS (SELECT page_id, sum(mean) / count(*) AS v FROM w JOIN m USING (word) GROUP BY page_id)
        SELECT page_id, round(coalesce(v, -1.0), 6) AS sentiment FROM feat LEFT JOIN s USING (page_id)""",
    "enrich_docs": f"""
        WITH {_BINS},
        k AS (SELECT x.doc_id, coalesce(lower(lang) IN ('en', 'fr', 'de') AND len(string_split(text, chr(10))) <= {ENRICH_LINES}
              AND {keyword_sql('text', DOC_KEYWORDS)} AND p >= 0.5, false) AS good, p FROM x JOIN s USING (doc_id))
        SELECT doc_id, CASE WHEN good THEN 0 ELSE 1 END AS status, CASE WHEN good THEN 1 END AS keyword_class,
               CASE WHEN good THEN round(p, 6) END AS topic_score FROM k""",
}
