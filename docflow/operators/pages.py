"""Page features (X2-X5, A2, F12, F13) and the blocks table.

The blocks of a page are an array inside the page row, so every per-page
feature is a narrow, map-only projection: no explode, no shuffle, and a hot
site costs no more than any other.  ``blocks_table`` explodes them only for
callers that want one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.constants import H1_PREPEND_SITES, REGION_LANG
from docflow.functions import html as H
from docflow.functions.paths import url_host, url_path
from docflow.functions.text import keyword_flag, line_count
from docflow.operators.routing import normalize_lang


def with_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``blocks`` (array of block structs) and ``title``; drop the raw
    html so it is not carried further."""
    return pages.withColumn("title", H.title(html)).withColumn("blocks", H.blocks(html))


def blocks_table(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per block (key, pos, tag, is_link, text)."""
    return (pages.select(key, F.explode(H.blocks(html)).alias("b"))
            .select(key, F.col("b.pos").cast("long").alias("pos"), "b.tag", "b.is_link", "b.text"))


ALL_FEATURES = ["html_lang", "title", "content_num", "link_num", "first_par", "first_h1", "heading_level",
                "heading_pos", "main_heading", "link_list", "link_dominated", "text", "n_lines"]


def page_features(pages: DataFrame, key: str = "page_id", html: str = "html",
                  url: str | None = "url", features=None, keep=(), list_limits: dict | None = None,
                  link_factor: float | None = None) -> DataFrame:
    """One row per page: title, block counts, first <p>/<h1>, main heading,
    link-list and link-dominated flags, extracted text and line count.
    ``features`` limits the output to the named ones (default: all); the
    others are not computed.  ``keep``: further input columns carried
    through unchanged (so callers need no join back to the input).
    ``list_limits`` (max_p, share) and ``link_factor``: other limits for the
    link-list and link-dominated flags.

    With ``url``: also host (site), first path folder (region) and the source
    language (<html lang> if present, else the region's language).

    The result is materialized (see ``materialize``): a later filter on a
    feature does not make Spark cut the HTML a second time."""
    want = list(features or ALL_FEATURES)
    if url:
        want += [f for f in ("html_lang",) if f not in want]
    cols = [key, *keep] + ([url] if url else [])
    df = with_blocks(pages.select(*cols, html), html)
    bl = F.col("blocks")
    needs_head = any(f in want for f in ("heading_level", "heading_pos", "main_heading", "link_dominated"))
    if needs_head:
        # Used by several features: its own projection, computed once per page.
        df = df.withColumn("_head", H.heading(bl))
    head = F.col("_head")
    build = {
        "html_lang": lambda: H.html_lang(html),
        "title": lambda: F.col("title"),
        "content_num": lambda: H.content_count(bl).cast("long"),
        "link_num": lambda: H.link_count(bl).cast("long"),
        "first_par": lambda: H.first_text(bl, "p", need_text=False),
        "first_h1": lambda: H.first_text(bl, "h1", need_text=False),
        "heading_level": lambda: head["level"],
        "heading_pos": lambda: head["pos"],
        "main_heading": lambda: head["text"],
        "link_list": lambda: H.link_list(bl, **(list_limits or {})),
        "link_dominated": lambda: H.link_dominated(bl, head["pos"], *([link_factor] if link_factor is not None else [])),
        "text": lambda: H.extracted_text(F.col("title"), bl),
    }
    sel = [build[f]().alias(f) for f in ALL_FEATURES if f in want and f in build]
    if "n_lines" in want and "text" not in want:
        sel.append(H.extracted_text(F.col("title"), bl).alias("text"))
    out = df.select(*cols, *sel)
    if "n_lines" in want:
        out = out.withColumn("n_lines", line_count("text").cast("long"))
        if "text" not in want:
            out = out.drop("text")
    out = materialize(out)
    if url:
        region = F.regexp_extract(url_path(url), r"\A/([^/]+)/", 1)
        lang_map = F.create_map(*[F.lit(x) for kv in REGION_LANG.items() for x in kv])
        out = (out.withColumn("site", url_host(url))
               .withColumn("region", F.when(region != "", region))
               .withColumn("src_lang", normalize_lang(
                   F.coalesce(F.col("html_lang"), F.try_element_at(lang_map, F.col("region"))))))
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Compute the columns of ``df`` once per row, even under later filters.

    Catalyst pushes a filter below a projection by inlining the projected
    expressions into the condition, so an expensive column used by both (the
    HTML blocks behind every page feature) would be evaluated twice.  A
    one-row ``inline`` turns the projection into a Generate, which a filter
    on its output does not cross."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def prepend_h1(df: DataFrame, text: str = "text", first_h1: str = "first_h1", site: str = "site",
               sites=H1_PREPEND_SITES) -> DataFrame:
    """For listed sites, the first <h1> line goes before the text."""
    hit = F.lit(False)
    for s in sites:
        hit = hit | F.col(site).contains(s)
    h1 = F.col(first_h1)
    return df.withColumn(text, F.when(hit & (F.length(h1) > 0), F.concat(h1, F.lit("\n"), F.col(text)))
                         .otherwise(F.col(text)))


def keyword_pages(df: DataFrame, keywords, text: str = "text") -> DataFrame:
    """F1 on extracted text, materialised as a column."""
    return df.withColumn("keyword_flag", keyword_flag(text, keywords))
