"""HTML -> blocks, as column expressions (X2-X5 building blocks).

There is no HTML parser here: a page is cut into *blocks* at block-level
tags with regexes, inside the executor, without leaving the JVM.  Each block
starts with its own tag, so its tag, whether it holds a link, and its text are
plain string functions of the block.  The blocks stay an array inside the page
row, so per-page features need no explode and no shuffle.

The same rules are written in DuckDB SQL by the oracle, so every pattern here
keeps to the subset both Java regex and RE2 accept.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.constants import LINK_DOMINATED_FACTOR, LINK_LIST_MAX_P, LINK_LIST_SHARE
from docflow.functions.regex import WS_STRING

# Removed before cutting: comments, scripts, styles and the whole <head>.
PRE_STRIP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<title\b.*?</title>"
# Opening or closing block-level tag (no <br>): each one starts a new block.
BLOCK_TAG = (r"(?i)</?(?:p|li|h[1-9]|div|ul|ol|nav|article|section|header|footer"
             r"|tr|td|table|body|html)\b[^>]*>")
TAG_NAME = r"^<(/?[a-zA-Z0-9]+)"
LINK = r"(?i)<a\b"
ANY_TAG = r"<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
ANCHOR_TEXT = r"(?is)<a\b[^>]*>(.*?)</a>"
STRONG_TEXT = r"(?is)<strong\b[^>]*>(.*?)</strong>"
STRONG_OPEN = r"(?i)<strong\b"
HTML_LANG = r"(?i)<html\b[^>]*\blang=[\"']?([a-zA-Z_-]+)"
SEP = "\u0001"

# Character references end with a semicolon; names come from the HTML5 table of
# the standard library, and a no-break space is written as a plain one.
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});"
_NAMES = "\u0002".join(f"{k[:-1]}\u0003{' ' if k == 'nbsp;' else v}" for k, v in html5.items() if k.endswith(";"))


def _reference(name: Column) -> Column:
    """The text a reference stands for, null if there is no such one."""
    hexa = F.conv(F.substring(name, 3, 6), 16, 10)
    point = F.when(name.rlike("^#[xX]"), hexa).otherwise(F.substring(name, 2, 7)).try_cast("int")
    valid = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point < 0x110000))
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    names = F.str_to_map(F.lit(_NAMES), F.lit("\u0002"), F.lit("\u0003"))
    return F.when(name.startswith("#"), char).otherwise(F.try_element_at(names, name))


def decode_entities(col: Column) -> Column:
    """Character references decoded in one pass (``&amp;lt;`` gives ``&lt;``):
    the text is cut at each ``&`` and every piece after one looked up."""
    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, REFERENCE, 1)
        found = F.when(name != "", F.concat(_reference(name), F.substring(p, F.length(name) + 2, F.length(p))))
        return F.when(i == 0, p).otherwise(F.coalesce(found, F.concat(F.lit("&"), p)))
    return F.array_join(F.transform(F.split(col, "&", -1), piece), "")


def tag_text(col: Column) -> Column:
    """Markup removed, entities decoded, blanks stripped."""
    return F.trim(decode_entities(F.regexp_replace(col, ANY_TAG, "")), F.lit(WS_STRING))


def _sum_len(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0), lambda acc, x: acc + F.length(
        decode_entities(F.regexp_replace(x, ANY_TAG, ""))))


def tokens(html) -> Column:
    """The page cut into raw blocks (array<string>), in page order."""
    h = F.col(html) if isinstance(html, str) else html
    marked = F.regexp_replace(F.regexp_replace(h, PRE_STRIP, ""), BLOCK_TAG, SEP + "$0")
    return F.split(marked, SEP, -1)


def block_struct(tok: Column, pos: Column) -> Column:
    """One block: position, lower-case tag ('p', '/p', 'h1', ... or '' for the
    text before the first block tag), link flag, text, and the raw block
    (kept for rules that look inside it, e.g. anchor text lengths)."""
    return F.struct(
        pos.alias("pos"),
        F.lower(F.regexp_extract(tok, TAG_NAME, 1)).alias("tag"),
        tok.rlike(LINK).alias("is_link"),
        tag_text(tok).alias("text"),
        tok.alias("raw"),
    )


def anchor_len(b: Column) -> Column:
    """Text length of the anchors inside a block (0 for a block without a
    link, without running the extraction)."""
    return F.when(b["is_link"], _sum_len(F.regexp_extract_all(b["raw"], F.lit(ANCHOR_TEXT), F.lit(1)))) \
        .otherwise(F.lit(0))


def strong_len(b: Column) -> Column:
    """Text length of the <strong> parts inside a block."""
    return F.when(b["raw"].rlike(STRONG_OPEN), _sum_len(F.regexp_extract_all(b["raw"], F.lit(STRONG_TEXT), F.lit(1)))) \
        .otherwise(F.lit(0))


def blocks(html) -> Column:
    """array<struct<pos,tag,is_link,text,raw>>."""
    return F.transform(tokens(html), lambda t, i: block_struct(t, i))


def title(html) -> Column:
    """Text of <title>, taken before <head> is dropped; '' if none."""
    h = F.col(html) if isinstance(html, str) else html
    return tag_text(F.regexp_extract(h, TITLE, 1))


def html_lang(html) -> Column:
    """The lang attribute of <html>, lower case; null if absent."""
    h = F.col(html) if isinstance(html, str) else html
    v = F.lower(F.regexp_extract(h, HTML_LANG, 1))
    return F.when(v != "", v)


# --- per-page features over the blocks array (no explode, no shuffle) -----

def is_content(b: Column) -> Column:
    return (b["text"] != "") & ~b["is_link"]


def is_link_block(b: Column) -> Column:
    return (b["text"] != "") & b["is_link"]


def content_count(bl: Column) -> Column:
    """A2: blocks with text and no link."""
    return F.size(F.filter(bl, is_content))


def link_count(bl: Column) -> Column:
    """A2: blocks with text and a link."""
    return F.size(F.filter(bl, is_link_block))


def content_text(bl: Column) -> Column:
    """Content block texts joined by newlines, in page order."""
    return F.array_join(F.transform(F.filter(bl, is_content), lambda b: b["text"]), "\n")


def extracted_text(title_col: Column, bl: Column) -> Column:
    """Title line followed by the content lines (what extraction writes)."""
    parts = F.concat(F.array(title_col), F.transform(F.filter(bl, is_content), lambda b: b["text"]))
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def first_text(bl: Column, tag: str, need_text: bool = True) -> Column:
    """Text of the first block with ``tag`` ('' if none); with
    ``need_text`` the first one that has text."""
    cond = (lambda b: (b["tag"] == tag) & (b["text"] != "")) if need_text else (lambda b: b["tag"] == tag)
    return F.coalesce(F.get(F.filter(bl, cond), 0)["text"], F.lit(""))


def heading(bl: Column) -> Column:
    """The main heading, struct<level,pos,text> or null.

    Levels h1, h2, ... in turn; within a level the first heading that holds
    no link and has text.  That is the least (level, pos) among usable ones."""
    usable = F.filter(bl, lambda b: b["tag"].rlike("^h[1-9]$") & ~b["is_link"] & (b["text"] != ""))
    return F.array_min(F.transform(usable, lambda b: F.struct(
        F.substring(b["tag"], 2, 1).cast("int").alias("level"), b["pos"].alias("pos"),
        b["text"].alias("text"))))


def link_list(bl: Column, max_p: int = LINK_LIST_MAX_P, share: float = LINK_LIST_SHARE) -> Column:
    """has <li>; the text of <p> blocks without links, cleaned, is at
    most ``max_p`` chars; more than ``share`` of <li> blocks hold a link."""
    from docflow.functions.text import clean_ja
    n_li = F.size(F.filter(bl, lambda b: b["tag"] == "li"))
    n_li_a = F.size(F.filter(bl, lambda b: (b["tag"] == "li") & b["is_link"]))
    p_len = F.aggregate(F.filter(bl, lambda b: (b["tag"] == "p") & ~b["is_link"]), F.lit(0),
                        lambda acc, b: acc + F.length(clean_ja(b["text"])))
    return (n_li > 0) & (p_len <= max_p) & (n_li_a > n_li * F.lit(share))


def link_dominated(bl: Column, head_pos: Column, factor: float = LINK_DOMINATED_FACTOR) -> Column:
    """after the main heading, anchor text is more than ``factor`` times
    the text of <p> and <strong>; false when that text is empty; null without heading.
    <strong> and <a> inside <p> count twice, as in the original walk."""
    # Blocks sit at index = pos, so "after the heading" is a slice, taken
    # once per page (a lambda referring to ``head_pos`` would evaluate it
    # again for every block).
    after = F.slice(bl, head_pos + 2, F.greatest(F.size(bl) - head_pos - 1, F.lit(0)))
    a_len = F.aggregate(after, F.lit(0), lambda acc, b: acc + anchor_len(b))
    p_len = F.aggregate(after, F.lit(0), lambda acc, b: acc + F.when(
        b["tag"] == "p", F.length(b["text"])).otherwise(0) + strong_len(b))
    return F.when(head_pos.isNull(), F.lit(None).cast("boolean")).when(
        p_len == 0, F.lit(False)).otherwise(a_len > p_len * F.lit(factor))
