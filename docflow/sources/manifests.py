"""Dated manifests (S3, S4, S7) and processed ledgers.

A manifest is a text file whose name carries a date and which lists one
page path per line.  Each file is small (one crawl hour), so it is read
whole and split into numbered lines: that gives every line an explicit
ordinal (date desc, file name, line number), which the original left to
glob order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.paths import region_of, site_of
from docflow.operators.ledger import union_all
from docflow.sources.files import plain_path

DATE_IN_NAME = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"


def manifest_lines(spark: SparkSession, folder: str, name_glob: str = "*.txt") -> DataFrame:
    """All lines of all manifests: (file_name, file_date, line_no, page_path),
    lines stripped, blank lines dropped."""
    df = (spark.read.option("pathGlobFilter", name_glob).text(folder, wholetext=True)
          .withColumn("file_name", F.element_at(F.split(plain_path(F.col("_metadata.file_path")), "/"), -1)))
    return parse_manifests(df)


def parse_manifests(df: DataFrame) -> DataFrame:
    """(value = whole manifest, file_name) -> numbered, stripped, non-blank
    lines.  Shared by the batch reader and the manifest stream."""
    df = df.select("file_name",
                   F.try_to_date(F.regexp_extract("file_name", DATE_IN_NAME, 1), "yyyy-MM-dd").alias("file_date"),
                   F.posexplode(F.split("value", "\n", -1)).alias("line_no", "page_path"))
    df = df.withColumn("page_path", F.regexp_replace("page_path", r"\A\s+|\s+\z", ""))
    return df.filter(F.col("page_path") != "")


def recent_pages(spark: SparkSession, folder: str, days: int, root: str, region: str | None = None,
                 today: dt.date | None = None, name_glob: str = "*.txt") -> DataFrame:
    """S3: lines of manifests dated within the last ``days`` days (today
    included), of one region (exact folder match), with their site; lines
    without a site are dropped.  ``ordinal`` orders newest day first."""
    return recent_lines(manifest_lines(spark, folder, name_glob), days, root, region, today)


def recent_lines(df: DataFrame, days: int, root: str, region: str | None = None,
                 today: dt.date | None = None) -> DataFrame:
    """S3 on parsed manifest lines (batch or one micro-batch)."""
    today = today or dt.date.today()
    first = today - dt.timedelta(days=days - 1)
    df = df.filter((F.col("file_date") >= F.lit(first)) & (F.col("file_date") <= F.lit(today)))
    df = df.withColumn("region", region_of("page_path", root)).withColumn("site", site_of("page_path", root))
    if region:
        df = df.filter(F.col("region") == region)
    df = df.filter(F.col("site").isNotNull())
    # Ascending ordinal = newest day first, then file name, then line.
    return df.withColumn("ordinal", F.struct(F.datediff(F.lit(today), "file_date").alias("age_days"),
                                             F.col("file_name"), F.col("line_no")))


def recent_posts(spark: SparkSession, folder: str, prefix: str, days: int | None = None,
                 today: dt.date | None = None, name_glob: str = "*.txt") -> DataFrame:
    """Manifest lines that start with ``prefix`` (all days if ``days``
    is None)."""
    df = manifest_lines(spark, folder, name_glob).filter(F.col("page_path").startswith(prefix))
    if days is not None:
        today = today or dt.date.today()
        df = df.filter(F.col("file_date") >= F.lit(today - dt.timedelta(days=days - 1)))
    return df


def merge_manifests(spark: SparkSession, folder: str, name_glob: str, out: str | None = None) -> DataFrame:
    """The union of many manifests as one list (optionally written)."""
    df = manifest_lines(spark, folder, name_glob).select("page_path")
    if out:
        df.write.mode("overwrite").text(out)
    return df


def read_ledger(spark: SparkSession, path: str, grammar: str = "first", stage: str | None = None) -> DataFrame:
    """An old text ledger as (page_path, domain, status).

    grammar: 'line'  - the whole stripped line is the path;
             'three' - "path domain status", lines without exactly three
                       fields skipped;
             'first' - first blank-separated field, any line with one.
    ``status`` is the last field when it is an integer."""
    df = spark.read.text(path)
    line = F.regexp_replace("value", r"\A\s+|\s+\z", "")
    f = F.filter(F.split(line, r"\s+", -1), lambda x: x != "")
    df = df.select(line.alias("line"), f.alias("f")).filter(F.col("line") != "")
    if grammar == "line":
        out = df.select(F.col("line").alias("page_path"), F.lit(None).cast("string").alias("domain"),
                        F.lit(None).cast("int").alias("status"))
    elif grammar == "three":
        out = df.filter(F.size("f") == 3).select(F.get("f", 0).alias("page_path"), F.get("f", 1).alias("domain"),
                                                 F.get("f", 2).try_cast("int").alias("status"))
    elif grammar == "first":
        out = df.select(F.get("f", 0).alias("page_path"), F.lit(None).cast("string").alias("domain"),
                        F.when(F.size("f") > 1, F.element_at("f", -1).try_cast("int")).alias("status"))
    else:
        raise ValueError(grammar)
    return out.withColumn("stage", F.lit(stage)) if stage else out


def read_ledgers(spark: SparkSession, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Many old ledgers, tagged by stage: {stage: (path, grammar)}."""
    return union_all([read_ledger(spark, p, g, stage=s) for s, (p, g) in paths.items()])
