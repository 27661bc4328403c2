"""Keyword dictionary.

The dictionary is one term list per language, aligned by line number.  It
is read as a long table (term_id, lang, term) and pivoted wide on demand.
Lookups search each text once for all terms (``term_search``), with no join
against the texts and no bound on the number of terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.term_search import search_terms

DICTIONARY_LANGS = ["ja", "en", "zh", "ko", "fr", "de", "sp"]


def read_keyword_lists(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """{lang: path} -> (term_id, lang, term), term_id = 0-based line."""
    frames = []
    for lang, path in files.items():
        t = spark.read.text(path, wholetext=True)
        frames.append(t.select(F.lit(lang).alias("lang"),
                               F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1))
                               .alias("term_id", "term")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("term", F.regexp_replace("term", r"\A\s+|\s+\z", ""))


def merge_wide(long: DataFrame, langs=DICTIONARY_LANGS) -> DataFrame:
    """Positional zip of the lists: one row per term_id, one column per
    language (null where a list is shorter)."""
    return long.groupBy("term_id").pivot("lang", list(langs)).agg(F.first("term")).orderBy("term_id")


def merged_lines(wide: DataFrame, langs=DICTIONARY_LANGS) -> DataFrame:
    """J8 output form: one tab-separated line per term_id."""
    return wide.select("term_id", F.concat_ws("\t", *[F.coalesce(F.col(l), F.lit("")) for l in langs]).alias("line"))


def hits_per_lang(df: DataFrame, text: str, long: DataFrame, block_chars: int | None = None, langs=None) -> DataFrame:
    """X11: per text, the dictionary terms found (``kw_found``: term_id, lang,
    term) and a hit count per language (``langs``; by default those of the
    dictionary).  Each text is searched once for all terms (``term_search``)."""
    out = search_terms(df, text, long, "kw_found", block_chars)
    for l in langs or sorted(r.lang for r in long.select("lang").distinct().collect()):
        out = out.withColumn(f"hits_{l}", F.size(F.filter(F.col("kw_found"), lambda k: k["lang"] == l)))
    return out


def any_term(df: DataFrame, text: str, long: DataFrame, lang: str | None = None) -> DataFrame:
    """F1 with the dictionary's terms (one language or all)."""
    found = search_terms(df, text, long if lang is None else long.filter(F.col("lang") == lang), "__found")
    return found.withColumn("keyword_flag", F.size("__found") > 0).drop("__found")


def normalisation_table(long: DataFrame, to_lang: str) -> DataFrame:
    """X11 as a translation memory: (from_lang, to_lang, term, target) for
    every other language of the same line.  'sp' in the lists means Spanish ('es')."""
    code = lambda c: F.when(c == "sp", "es").otherwise(c)
    target = long.filter((F.col("lang") == to_lang) & (F.col("term") != "")).select("term_id", F.col("term").alias("target"))
    rows = long.filter((F.col("lang") != to_lang) & (F.col("term") != "")).join(target, "term_id").filter("term <> target")
    return rows.select("term_id", code(F.col("lang")).alias("from_lang"), code(F.lit(to_lang)).alias("to_lang"), "term", "target")


def normalise_terms(long: DataFrame, to_lang: str) -> list[tuple[str, str, str, str]]:
    """``normalisation_table`` in line order, for ``translate.dictionary_translator``."""
    rows = normalisation_table(long, to_lang).orderBy("term_id", "from_lang").toLocalIterator()
    return [(r.from_lang, r.to_lang, r.term, r.target) for r in rows]


def keyword_classes(df: DataFrame, text: str, class_terms, out: str = "keyword_classes") -> DataFrame:
    """U2 keyword classification: the classes (sorted) whose terms occur in
    the text.  ``class_terms``: (class, term) pairs, as a list or as a table
    (columns class and term).  Each text is searched once for all terms."""
    if not isinstance(class_terms, DataFrame):
        class_terms = df.sparkSession.createDataFrame(list(class_terms), "class string, term string")
    long = class_terms.select(F.lit(0).alias("term_id"), F.col("class").cast("string").alias("lang"), F.col("term").cast("string").alias("term"))
    found = search_terms(df, text, long.filter("lang is not null"), "__found")
    return found.withColumn(out, F.array_sort(F.array_distinct(F.transform("__found", lambda k: k["lang"])))).drop("__found")
