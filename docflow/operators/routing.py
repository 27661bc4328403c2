"""Language routing and the status cascade.

Routes are a fixed table of a few dozen pairs, so they are a literal map
inside the plan: no join at all, not even a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import constants as K
from docflow.functions.text import keyword_flag, line_count


def normalize_lang(col) -> Column:
    """Lower case; any code holding 'cn' (e.g. zh-cn) means Chinese 'zh'."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    return F.when(c.contains("cn"), F.lit("zh")).otherwise(c)


def source_lang(region, lang_file=None) -> Column:
    """P10: the region's language, overridden by a guessed-language value."""
    lang_map = F.create_map(*[F.lit(x) for kv in K.REGION_LANG.items() for x in kv])
    r = F.try_element_at(lang_map, F.col(region) if isinstance(region, str) else region)
    if lang_file is None:
        return normalize_lang(r)
    lf = F.col(lang_file) if isinstance(lang_file, str) else lang_file
    return normalize_lang(F.coalesce(F.when(F.trim(lf) != "", F.trim(lf)), r))


def route_supported(src_lang, to_lang, routes=None) -> Column:
    """A translation route exists from ``src_lang`` to ``to_lang``
    (same language counts as a route: the text passes through)."""
    routes = routes or K.ROUTE_SOURCES
    m = F.create_map(*[x for to, srcs in routes.items()
                       for x in (F.lit(to), F.array(*[F.lit(s) for s in srcs]))])
    src = F.col(src_lang) if isinstance(src_lang, str) else src_lang
    to = F.col(to_lang) if isinstance(to_lang, str) else to_lang
    return F.coalesce(F.array_contains(F.try_element_at(m, to), src), F.lit(False))


def route_table(spark, routes=None) -> DataFrame:
    """J5 as a table (from_lang, to_lang), for callers that want to join."""
    routes = routes or K.ROUTE_SOURCES
    rows = [(s, t) for t, srcs in routes.items() for s in srcs]
    return spark.createDataFrame(rows, "from_lang string, to_lang string")


def with_targets(df: DataFrame, to_langs=("ja", "en")) -> DataFrame:
    """One row per item and target language (a generator, not a join)."""
    return df.withColumn("to_lang", F.explode(F.array(*[F.lit(t) for t in to_langs])))


def density_ok(content_num, link_num, region=None, limit: float = K.DENSITY_LIMIT,
               exempt: str = K.DENSITY_EXEMPT_REGION) -> Column:
    """(content+1)/(content+links+1) >= limit, or an exempt region."""
    c, l = F.col(content_num), F.col(link_num)
    ok = ~((c + 1) / (c + l + 1) < F.lit(limit))
    if region is not None:
        ok = ok | F.coalesce(F.col(region) == exempt, F.lit(False))
    return ok


def status_cascade(*, src_lang: str, to_lang: str, has_files: Column, keyword_hit: Column,
                   content_num: str, link_num: str, n_lines: Column, text_len: Column,
                   region: str | None = None, exists: Column | None = None,
                   max_lines: int = K.MAX_LINES, density: float = K.DENSITY_LIMIT,
                   routes=None) -> Column:
    """F8: one status code per item, first match wins:
    9 no route, 5 already done, 4 files or meta missing, 1 no keyword,
    2 too many links, 7 too long (unless same language), 3 too short, 0 ok.
    (6 and 8 are write failures and are recorded by the writer.)"""
    same = F.col(src_lang) == F.col(to_lang)
    ok_density = density_ok(content_num, link_num, region, density)
    s = F.when(~route_supported(src_lang, to_lang, routes) | F.col(src_lang).isNull(), K.STATUS_NO_ROUTE)
    if exists is not None:
        s = s.when(exists, K.STATUS_EXISTS)
    return (s.when(~has_files, K.STATUS_MISSING_FILES)
            .when(~keyword_hit, K.STATUS_NO_KEYWORD)
            .when(~ok_density, K.STATUS_TOO_MANY_LINKS)
            .when(~F.coalesce(same, F.lit(False)) & (n_lines > max_lines), K.STATUS_TOO_LONG)
            .when(text_len <= 1, K.STATUS_SHORT)
            .otherwise(K.STATUS_OK))


def page_status(features: DataFrame, to_lang: str, keywords, done: DataFrame | None = None,
                key: str = "page_id", **kw) -> DataFrame:
    """F8 over page features (from ``operators.pages.page_features``).

    ``done`` (optional): items already translated to ``to_lang``; matched by
    a left-semi flag join on ``key`` (both sides keyed by a unique id)."""
    df = features.withColumn("to_lang", F.lit(to_lang))
    exists = None
    if done is not None:
        d = done.select(F.col(key).alias("_done_key")).distinct().withColumn("_done", F.lit(True))
        df = df.join(d, df[key] == d["_done_key"], "left").drop("_done_key")
        exists = F.coalesce(F.col("_done"), F.lit(False))
    has_files = (F.length("text") > 0)
    st = status_cascade(src_lang="src_lang", to_lang="to_lang", has_files=has_files,
                        keyword_hit=keyword_flag("text", keywords), content_num="content_num",
                        link_num="link_num", n_lines=F.col("n_lines"), text_len=F.length("text"),
                        region="region", exists=exists, **kw)
    out = df.withColumn("status", st)
    return out.drop("_done") if done is not None else out


def text_status(docs: DataFrame, to_langs, keywords, text: str = "text", lang: str = "lang",
                **kw) -> DataFrame:
    """F8 for plain-text items (no link counts): one row per item and target.

    The text checks (keyword scan, line count, length) are computed once per
    item, before the rows are repeated per target."""
    df = (docs.withColumn("src_lang", normalize_lang(lang))
          .withColumn("_len", F.length(text))
          .withColumn("_kw", F.coalesce(keyword_flag(text, keywords), F.lit(False)))
          .withColumn("_nl", line_count(text)))
    df = with_targets(df, to_langs).withColumn("_c", F.lit(1)).withColumn("_l", F.lit(0))
    st = status_cascade(src_lang="src_lang", to_lang="to_lang",
                        has_files=F.coalesce(F.col("_len") > 0, F.lit(False)),
                        keyword_hit=F.col("_kw"), content_num="_c", link_num="_l",
                        n_lines=F.col("_nl"), text_len=F.col("_len"), **kw)
    return df.withColumn("status", st).drop("_c", "_l", "_len", "_kw", "_nl")
