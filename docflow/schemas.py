"""The data model as Spark types.

Storage in the original was files and one-line text records; here every
hand-over is a typed table.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# A crawled page: where it lives, when it was crawled, its HTML.
PAGE = _s(("file_path", StringType()), ("mtime", TimestampType()), ("region", StringType()),
          ("html", StringType()))

# One numbered line of a dated manifest.
MANIFEST_LINE = _s(("file_name", StringType()), ("file_date", DateType()), ("line_no", IntegerType()),
                   ("page_path", StringType()))

# Ledger line (all three old grammars fit: path only, path+status, path+domain+status).
LEDGER = _s(("page_path", StringType()), ("stage", StringType()), ("status", IntegerType()),
            ("processed_at", TimestampType()), ("day", DateType()))

# The one-line meta record written by extraction.
META = _s(("translated", IntegerType()), ("mtime", DoubleType()), ("domain", StringType()),
          ("content_num", IntegerType()), ("link_num", IntegerType()), ("keyword_flag", BooleanType()))

# Block document: title, ordered content strings, counts.
BLOCKS = _s(("title", StringType()), ("contents", ArrayType(StringType())), ("text", StringType()),
            ("content_num", IntegerType()), ("link_num", IntegerType()))

# Time fields of an index record.
RECORD_TIME = _s(("year", IntegerType()), ("month", IntegerType()), ("day", IntegerType()),
                 ("hh", IntegerType()), ("mm", IntegerType()), ("local", TimestampNTZType()),
                 ("utc", TimestampNTZType()))

# Index record of a page (tweets: country instead of region/domain/path/url).
INDEX_RECORD = _s(("text", StringType()), ("region", StringType()), ("domain", StringType()),
                  ("path", StringType()), ("timestamp", RECORD_TIME), ("filename", StringType()),
                  ("url", StringType()))

# Keyword dictionary, long form.
KEYWORD = _s(("term_id", IntegerType()), ("lang", StringType()), ("term", StringType()))

# A short post.
POST = _s(("post_path", StringType()), ("ordinal", LongType()), ("text", StringType()), ("lang", StringType()))
