"""Newest-version table and append-only table (K6, K7, K8).

Plain Parquet has no MERGE, so versions are appended to a history and the
"index" is derived from it.  The winner of each id is found on narrow columns
by a hash aggregation of one fixed-width number (time and arrival), which each
task does for its own rows first; then the winning rows are fetched by a
semi-join on id and number.  Rows with their texts are never sorted, and as the
number is part of the join key, an id that holds a third of all versions is
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HALF = 1 << 62


def _pick(history: DataFrame, key: str, order: Column, cols) -> DataFrame:
    cols = [c for c in (cols or history.columns) if c != key]
    marked = history.select(key, *cols, order.alias("_order"), _row_hash(history, [key, *cols]).alias("_hash"))
    best = marked.groupBy(F.col(key).alias("_key")).agg(F.max("_order").alias("_best"), F.max_by("_hash", "_order").alias("_which"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_order") == F.col("_best")) & (F.col("_hash") == F.col("_which"))
    return marked.join(best, same, "left_semi").drop("_order", "_hash")


def _row_hash(rows: DataFrame, cols) -> Column:
    """A row's hash, which decides between rows that tie on the order (maps,
    which have none, are left out)."""
    plain = [c for c in cols if "map<" not in rows.schema[c].dataType.simpleString()]
    return F.xxhash64(*[F.col(c) for c in plain])


def _late(arrival: str) -> Column:
    return F.lit(_HALF) - F.coalesce(F.col(arrival).cast("long"), F.lit(0))


def latest_version(history: DataFrame, key: str, ts: str, arrival: str, cols=None) -> DataFrame:
    """K6: per ``key`` the version with the greatest ``ts`` (null: the
    least); among equal ``ts`` the earliest ``arrival`` (a later equal one is
    not newer, so it does not replace).  ``arrival`` is a numeric arrival
    order, unique for a key and time; of rows that tie on all three one
    stays (all copies of it, if they are equal in every column)."""
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-_HALF))
    wide = micros.cast("decimal(19,0)") * F.lit(str(2 * _HALF)).cast("decimal(19,0)") + _late(arrival).cast("decimal(19,0)")
    return _pick(history, key, wide.cast("decimal(38,0)"), cols)


def first_version(history: DataFrame, key: str, arrival: str, cols=None) -> DataFrame:
    """K7: append-only target with create-only writes: the first arrival
    per ``key`` stays, later ones are refused."""
    return _pick(history, key, _late(arrival), cols)


def index_records(items: DataFrame, urls: DataFrame, texts: DataFrame | None, key: str) -> tuple[DataFrame, DataFrame]:
    """K8: an index record needs both its URL and its text.

    Returns (records, skipped): records = items ⋈ urls ⋈ texts, skipped =
    items with either missing.  All three are keyed by the unique item key.
    ``texts=None`` when the items already carry their (non-null) text."""
    rec = items.join(urls, key, "inner")
    if texts is not None:
        rec = rec.join(texts, key, "inner")
    skipped = items.join(rec.select(key), key, "left_anti")
    return rec, skipped


def index_record(text, parts, url) -> "F.Column":
    """The index document of a page, as the original built it: text,
    region, domain (site), path, the time fields of the crawl folder
    (year, month, day, hh, mm, local, utc), file name and URL.  ``parts`` is
    the struct from ``functions.paths.page_parts``."""
    c = (lambda x: F.col(x) if isinstance(x, str) else x)
    p = c(parts)
    ts = F.struct(p["year"].alias("year"), p["month"].alias("month"), p["day"].alias("day"),
                  p["hh"].alias("hh"), p["mm"].alias("mm"), p["ts_local"].alias("local"), p["ts_utc"].alias("utc"))
    return F.struct(c(text).alias("text"), p["region"].alias("region"), p["site"].alias("domain"),
                    p["path"].alias("path"), ts.alias("timestamp"), p["filename"].alias("filename"),
                    c(url).alias("url"))


def newer_than(candidates: DataFrame, current: DataFrame, key: str, ts: str) -> DataFrame:
    """The newer-than gate of K6 as a join: candidates whose id is absent
    from ``current`` or whose ``ts`` is strictly later."""
    cur = current.select(F.col(key).alias("_k"), F.col(ts).alias("_ts"))
    j = candidates.join(cur, candidates[key] == cur["_k"], "left")
    return j.filter(F.col("_k").isNull() | (F.col(ts) > F.col("_ts"))).drop("_k", "_ts")
