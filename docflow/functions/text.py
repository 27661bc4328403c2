"""Text predicates and cleaners."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docflow.constants import DATE_PATTERN, JA_SITE_SUFFIXES, LATIN_HEAD, LATIN_SHARE, LINK_WORD, TITLE_CUT_MARKERS
from docflow.functions.regex import NON_WS, WORD, WS, WS_STRING


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode blanks."""
    return F.trim(_c(col), F.lit(WS_STRING))


def keyword_flag(col, keywords, ignore_case: bool = False) -> Column:
    """true when the text holds any keyword as a substring.

    Case-sensitive by default, like the original.  An OR of ``contains``
    (code-generated, short-circuit), built as a balanced tree so that a long
    list gives a flat plan."""
    text = _c(col)
    kws = [k for k in dict.fromkeys(keywords) if k]
    if ignore_case:
        text = F.lower(text)
        kws = list(dict.fromkeys(k.lower() for k in kws))
    return any_of([text.contains(k) for k in kws])


def any_of(conditions: list[Column]) -> Column:
    """OR of all conditions, as a balanced tree; false for none."""
    level = list(conditions)
    while len(level) > 1:
        level = [a | b for a, b in zip(level[::2], level[1::2])] + ([level[-1]] if len(level) % 2 else [])
    return level[0] if level else F.lit(False)


def line_count(col) -> Column:
    """Number of lines as ``text.split('\\n')`` counts them."""
    return F.size(F.split(_c(col), "\n", -1))


def too_long(col, max_lines: int) -> Column:
    """more than ``max_lines`` lines."""
    return line_count(col) > F.lit(max_lines)


def is_short(col) -> Column:
    """empty or single-character output."""
    return F.coalesce(F.length(_c(col)) <= 1, F.lit(True))


def latin_count(col) -> Column:
    c = _c(col)
    return F.length(c) - F.length(F.regexp_replace(c, "[a-zA-Z]", ""))


def mostly_latin(col) -> Column:
    """after removing blanks, at least 200 chars and more than 60 % of
    the first 200 are ASCII letters.  (``length(head) = 200`` is the same
    as "at least 200 chars", and keeps the text itself out of the result
    expression so it is cleaned once.)"""
    t = strip(F.translate(_c(col), "　 \t", ""))
    head = F.substring(t, 1, LATIN_HEAD)
    return (F.length(head) >= LATIN_HEAD) & (latin_count(head) > F.length(head) * F.lit(LATIN_SHARE))


def date_mention(col) -> Column:
    """mentions a month, a 199x/20xx year or a Japanese era."""
    return _c(col).rlike(DATE_PATTERN)


def link_word(col) -> Column:
    """contains the Japanese word for 'link'."""
    return _c(col).contains(LINK_WORD)


def clean_en(col) -> Column:
    """Tab -> space, then strip."""
    return strip(F.regexp_replace(_c(col), "\t", " "))


def clean_ja(col) -> Column:
    """Text that is more than half ASCII letters is cleaned as X7;
    otherwise every blank (half-width, full-width, tab) is removed, the text
    stripped and three known site suffixes dropped."""
    c = _c(col)
    ja = strip(F.translate(strip(c), " 　\t", ""))
    for suffix in JA_SITE_SUFFIXES:
        ja = F.replace(ja, F.lit(suffix), F.lit(""))
    return F.when(latin_count(c) > F.floor(F.length(c) / 2), clean_en(c)).otherwise(ja)


# A URL, or a hashtag with the blanks after it.  One pass, so a '#'
# inside a URL is not guarded twice.
GUARD_PATTERN = rf"https?://{NON_WS}+|[#＃]{WORD}+{WS}*"


def guard_tags(col) -> Column:
    """Wrap URLs and hashtags in ｟ ｠ so a translator leaves them alone."""
    return F.regexp_replace(_c(col), GUARD_PATTERN, " ｟$0 ｠ ")


def leading_newlines(col) -> Column:
    """The run of newlines at the start."""
    return F.regexp_extract(_c(col), r"\A(\n*)", 1)


def trailing_newlines(col) -> Column:
    """The run of newlines at the end, not counting the leading run
    (a text of newlines only is all leading), so restoring adds it once."""
    rest = F.regexp_replace(_c(col), r"\A\n*", "")
    return F.regexp_extract(rest, r"(\n*)\z", 1)


HTML_HEAD = '<html>\n<head><meta charset="utf-8"/></head>\n<body>\n'
HTML_TAIL = "</body>\n</html>\n"


def escape_html(col) -> Column:
    c = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def render_html(col, escape: bool = False) -> Column:
    """One ``<p>`` per line.  The original does not escape; ``escape``
    turns it on."""
    lines = F.split(_c(col), "\n", -1)
    if escape:
        lines = F.transform(lines, escape_html)
    body = F.array_join(F.transform(lines, lambda l: F.concat(F.lit("<p>"), l, F.lit("</p>\n"))), "")
    return F.concat(F.lit(HTML_HEAD), body, F.lit(HTML_TAIL))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC (Spark has no built-in); Arrow-batched."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if isinstance(x, str) else None)


def clean_title(col) -> Column:
    """NFKC, drop half-width spaces, cut from '−', 'ーY' or '|' to the
    end of the (last) line."""
    t = F.replace(nfkc(_c(col)), F.lit(" "), F.lit(""))
    for start in TITLE_CUT_MARKERS:
        t = F.regexp_replace(t, re.escape(start) + r"[^\n]+(?=\n?\z)", "")
    return t
