"""Crawl-tree scans (S1, S2, S13) and sidecar readers.

All reads are Spark file sources: listing and reading are spread over
executors, ``_metadata`` gives the path and modification time without a
driver-side walk, and ``binaryFile`` skips file contents when only paths
are selected.
"""

from __future__ import annotations

import re

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from docflow.functions.paths import region_of, with_suffix
from docflow.operators.joins import MAX_BROADCAST_BYTES, checked_broadcast


def _meta(df: DataFrame) -> DataFrame:
    return (df.withColumn("file_path", plain_path(F.col("_metadata.file_path")))
            .withColumn("mtime", F.col("_metadata.file_modification_time")))


SCHEME = r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)"


def _strip_scheme(col):
    """A path without scheme and authority (``file:``, ``hdfs://host:port``,
    ``s3a://bucket``), as manifests list it."""
    return F.regexp_replace(col, SCHEME, "")


def plain_path(col):
    """The path a ``_metadata`` URI names: percent escapes decoded (a plus
    sign is itself), scheme and authority removed."""
    return _strip_scheme(F.url_decode(F.regexp_replace(col, r"\+", "%2B")))


def scan_pages(spark: SparkSession, root: str, region: str | None = None, stage: str = "orig",
               glob: str = "*.html", lenient: bool = False) -> DataFrame:
    """S1 (+ S13): every ``*.html`` below ``root/region/stage`` (or below
    every region's stage folder when ``region`` is None) as
    (file_path, mtime, region, html).

    ``lenient``: read bytes and drop what is not valid UTF-8 (the original
    decoded with 'ignore'); otherwise read as text."""
    base = f"{root.rstrip('/')}/{region or '*'}/{stage}"
    if lenient:
        df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob).load(base))
        df = df.select(F.col("path").alias("file_path"), F.col("modificationTime").alias("mtime"),
                       F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\ufffd", "").alias("html"))
    else:
        df = _meta(spark.read.option("recursiveFileLookup", "true")
                   .option("pathGlobFilter", glob).text(base, wholetext=True))
        df = df.select("file_path", "mtime", F.col("value").alias("html"))
    if lenient:            # binaryFile gives the path unescaped
        df = df.withColumn("file_path", _strip_scheme(F.col("file_path")))
    plain_root = re.sub(SCHEME, "", root)
    return df.withColumn("region", region_of("file_path", plain_root)).filter(F.col("region").isNotNull())


def scan_folder(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """S1, any-folder form: every ``glob`` file below ``folder`` as
    (file_path, mtime, html), whatever the layout."""
    df = _meta(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
               .text(folder, wholetext=True))
    return df.select("file_path", "mtime", F.col("value").alias("html"))


def scan_files(spark: SparkSession, data_dir: str, ignores=(), total: int | None = None) -> DataFrame:
    """Files below ``data_dir`` whose path matches no ``ignores`` regex,
    has no '?', and ends in .html, .htm or no suffix; at most ``total`` (in
    path order).  Only paths are read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(data_dir)
          .select(_strip_scheme(F.col("path")).alias("path")))
    for pat in ignores:
        df = df.filter(~F.col("path").rlike(pat))
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.regexp_extract(name, r"(?<=[^/])(\.[^./]+)\z", 1)
    df = df.filter(~F.col("path").contains("?")).filter(suffix.isin(".html", ".htm", ""))
    if total is not None:
        df = df.orderBy("path").limit(total)
    return df


def read_sidecar(spark: SparkSession, root: str, suffix: str, first_line: bool = False,
                 col: str | None = None) -> DataFrame:
    """Every ``*{suffix}`` file below ``root`` as (key, value) where key
    is the path without suffix; ``first_line`` keeps only line one.  All
    values are stripped."""
    df = _meta(spark.read.option("recursiveFileLookup", "true")
               .option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True))
    v = F.col("value")
    if first_line:
        v = F.substring_index(v, "\n", 1)
    key = F.regexp_replace("file_path", re.escape(suffix) + r"\z", "")
    return df.select(key.alias("key"), F.regexp_replace(v, r"\A\s+|\s+\z", "").alias(col or suffix.strip(".")))


def json_field(col, field: str):
    """One field of a JSON document (first line), null if broken."""
    return F.get_json_object(F.substring_index(F.col(col) if isinstance(col, str) else col, "\n", 1), f"$.{field}")


META_SCHEMA = ["translated", "mtime", "domain", "content_num", "link_num", "keyword_flag"]


def parse_meta(col) -> "F.Column":
    """The one-line meta record "0 mtime domain content links flag" as
    a struct; null when it does not have six fields of the right types (the
    caller turns that into status 4)."""
    c = F.col(col) if isinstance(col, str) else col
    f = F.split(F.regexp_replace(F.substring_index(c, "\n", 1), r"\A\s+|\s+\z", ""), " ", -1)
    s = F.struct(
        F.get(f, 0).try_cast("int").alias("translated"),
        F.get(f, 1).try_cast("double").alias("mtime"),
        F.get(f, 2).alias("domain"),
        F.get(f, 3).try_cast("int").alias("content_num"),
        F.get(f, 4).try_cast("int").alias("link_num"),
        (F.get(f, 5) != "False").alias("keyword_flag"))
    ok = (F.size(f) == 6) & s["translated"].isNotNull() & s["mtime"].isNotNull() \
        & s["content_num"].isNotNull() & s["link_num"].isNotNull()
    return F.when(ok, s)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as VARIANT (``record``), with ``_corrupt`` true for
    lines that do not parse; undecodable bytes are dropped."""
    df = _meta(spark.read.text(path))
    v = F.try_parse_json(F.col("value"))
    return df.select(F.col("file_path"), F.col("value").alias("line"), v.alias("record"),
                     v.isNull().alias("_corrupt"))


def classified_view(records: DataFrame, root: str) -> DataFrame:
    """S11 projection: title of the Japanese translation and absolute link
    of the original page."""
    r = F.col("record")
    return records.select(
        F.try_variant_get(r, "$.ja_translated.title", "string").alias("title"),
        F.concat(F.lit(root.rstrip("/") + "/"), F.try_variant_get(r, "$.orig.file", "string")).alias("link"),
        "_corrupt")


from docflow.constants import CONTENT_BLOCK_TYPES as CONTENT_TYPES  # noqa: E402


def parse_block_xml(col):
    """Title, content strings (in order), content and link block
    counts from a block XML document.  The title counts in the text but not
    in ``content_num``; an empty RawString is skipped."""
    c = F.col(col) if isinstance(col, str) else col
    cond = " or ".join(f'@BlockType="{t}"' for t in CONTENT_TYPES)
    title = F.xpath_string(c, F.lit("//Title/RawString"))
    contents = F.xpath(c, F.lit(f"//S[{cond}]/RawString/text()"))
    n_content = F.xpath_int(c, F.lit(f"count(//S[{cond}])"))
    n_all = F.xpath_int(c, F.lit("count(//S)"))
    text = F.array_join(F.filter(F.concat(F.array(title), contents), lambda x: F.coalesce(x, F.lit("")) != ""), "\n")
    return F.struct(title.alias("title"), contents.alias("contents"), text.alias("text"),
                    n_content.alias("content_num"), (n_all - n_content).alias("link_num"))


def read_dimension(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A small TSV dimension (class list, source info), broadcast after
    a check of its bytes; too large -> returned as a normal table."""
    r = spark.read.option("sep", "\t").option("header", str(header).lower())
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    b = checked_broadcast(df, max_bytes)
    return b if b is not None else df


def with_sidecars(pages: DataFrame, sidecars: dict[str, DataFrame], key: str = "key") -> DataFrame:
    """Left-join sidecar tables (key, value) to the pages by path stem."""
    out = pages
    for name, sc in sidecars.items():
        out = out.join(sc.withColumnRenamed(key, "_sk"), out[key] == F.col("_sk"), "left").drop("_sk")
    return out


def page_key(col):
    """Path without its suffix: the join key between a page and its sidecars."""
    return F.regexp_replace(with_suffix(col, ""), r"\A\s+", "")


def all_present(*cols) -> "F.Column":
    """every sidecar column is present (non-null)."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def read_named_files(df: DataFrame, path_col: str = "page_path", out: str = "html",
                     mtime: str = "mtime_s") -> DataFrame:
    """S13 for files named in a column (manifest lines): each executor opens
    the paths of its own rows on the shared disk, decodes UTF-8 dropping
    undecodable bytes (as the original did) and adds the file's modification
    time (epoch seconds).  A file that is not there gives nulls; any other
    error (permission, a stale mount) fails the task, so that it is tried
    again instead of being recorded as missing.  Only the named files are
    read, and no path list passes through the driver."""
    schema = StructType([*df.schema.fields, StructField(out, StringType()), StructField(mtime, DoubleType())])

    def run(batches):
        for b in batches:
            texts, times = [], []
            for p in b[path_col]:
                text = time = None
                if p is not None:
                    try:
                        with open(p, "rb") as fh:
                            text = fh.read().decode("utf-8", "ignore")
                            time = os.fstat(fh.fileno()).st_mtime
                    except (FileNotFoundError, NotADirectoryError):
                        pass
                texts.append(text)
                times.append(time)
            yield b.assign(**{out: pd.Series(texts, index=b.index, dtype=object),
                              mtime: pd.Series(times, index=b.index, dtype="float64")})
    return df.mapInPandas(run, schema)
