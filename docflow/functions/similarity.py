"""Pairwise text similarity of two columns in one row.

Both are scalar: the original compares two given strings.  Pair rows are
made by the caller from a natural key (title vs heading, turn vs next turn),
never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.regex import WS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def word_set(col) -> Column:
    """Distinct blank-separated tokens (``set(s.split())``)."""
    return F.array_distinct(F.filter(F.split(_c(col), WS + "+", -1), lambda t: t != ""))


def bigram_set(col) -> Column:
    """Distinct character bigrams of the text without blanks (used for
    scripts without blanks between words)."""
    s = F.regexp_replace(_c(col), WS + "+", "")
    n = F.length(s)
    idx = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    grams = F.transform(idx, lambda i: F.substring(s, i, 2))
    return F.array_distinct(F.filter(grams, lambda g: F.length(g) == 2))


def overlap_of_sets(a: Column, b: Column) -> Column:
    m = F.least(F.size(a), F.size(b))
    return F.when(m == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / m)


def word_overlap(s1, s2) -> Column:
    """J6 (blank tokens): |A∩B| / min(|A|,|B|), 0 when either set is empty."""
    return overlap_of_sets(word_set(s1), word_set(s2))


def text_overlap(s1, s2) -> Column:
    """Blank tokens when more than half of the non-blank characters of
    both texts are ASCII letters or digits; character bigrams otherwise (the
    original used a morphological analyser there)."""
    both = F.concat(_c(s1), _c(s2))
    alnum = F.length(both) - F.length(F.regexp_replace(both, "[a-zA-Z0-9]", ""))
    nonblank = F.length(F.replace(both, F.lit(" "), F.lit("")))
    latin = alnum > F.floor(nonblank / 2)
    return F.when(latin, word_overlap(s1, s2)).otherwise(
        overlap_of_sets(bigram_set(s1), bigram_set(s2)))


def edit_distance(s1, s2, threshold: int | None = None) -> Column:
    """Levenshtein distance in characters (-1 above ``threshold``)."""
    if threshold is None:
        return F.levenshtein(_c(s1), _c(s2))
    return F.levenshtein(_c(s1), _c(s2), threshold)
