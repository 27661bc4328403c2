"""Paths, URLs, ids and time.

A crawled page lives at
``{root}/{region}/{stage}/{site}/{path...}/{yyyy}/{mm}/{dd-hh-mm}/{name}.{ext}``
where ``stage`` is ``orig``, ``tmp`` or ``<lang>_translated``; a tweet at
``{root}/{country}/{stage}/{yyyy}/{mm}/{dd}/{hh-mm}/{id}.{ext}``.
Bad paths give nulls (``try_cast``), never an error.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.constants import REGIONS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _qr(s: str) -> str:
    """Quote a literal for a Java regex replacement string."""
    return s.replace("\\", "\\\\").replace("$", "\\$")


def swap_stage(path, src: str, dst: str) -> Column:
    """Replace the first ``/src/`` folder with ``/dst/``."""
    return F.regexp_replace(_c(path), r"\A(.*?)/" + re.escape(src) + "/", "$1/" + _qr(dst) + "/")


def with_suffix(path, suffix: str) -> Column:
    """``pathlib.Path.with_suffix``: replace (or add) the last suffix
    of the file name."""
    stem = F.regexp_replace(_c(path), r"(?<=[^/])\.[^./]+\z", "")
    return F.concat(stem, F.lit(suffix))


def stage_path(path, src: str, dst: str, suffix: str | None = None) -> Column:
    """The stage mappings orig <-> tmp <-> <lang>_translated."""
    p = swap_stage(path, src, dst)
    return with_suffix(p, suffix) if suffix else p


def relative_parts(path, root: str) -> Column:
    """Path components below ``root`` (array<string>)."""
    rel = F.regexp_replace(_c(path), r"\A" + re.escape(root.rstrip("/")) + "/", "")
    return F.split(rel, "/", -1)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _local_ts(year, month, day, hh, mm) -> Column:
    return F.try_make_timestamp_ntz(year, month, day, hh, mm, F.lit(0))


def to_utc(ts_local: Column, tz: str = "UTC") -> Column:
    """Naive local time in zone ``tz`` -> naive UTC time."""
    return F.to_utc_timestamp(ts_local.cast("timestamp"), tz).cast("timestamp_ntz")


def page_parts(path, root: str, tz: str = "UTC") -> Column:
    """P2 + P4: struct(region, site, path, year, month, day, hh, mm,
    filename, record_id, ts_local, ts_utc) of a page path.

    ``record_id`` = region/site/path/filename and does not depend on the
    stage folder, so one page has one id in every stage.  ``tz`` is the zone
    of the folder time stamps (the original used the host's zone)."""
    d = relative_parts(path, root)
    n = F.size(d)
    day_time = F.split(F.element_at(d, -2), "-", -1)
    name = F.element_at(d, -1)
    filename = F.regexp_replace(name, r".{1,4}\z", "")
    sub = F.slice(d, 4, F.greatest(n - 7, F.lit(0)))
    year, month = _int(F.element_at(d, -4)), _int(F.element_at(d, -3))
    day, hh, mm = _int(F.get(day_time, 0)), _int(F.get(day_time, 1)), _int(F.get(day_time, 2))
    ts_local = _local_ts(year, month, day, hh, mm)
    region, site, p = F.get(d, 0), F.get(d, 2), F.array_join(sub, "/")
    ok = n >= 7
    return F.when(ok, F.struct(
        region.alias("region"), site.alias("site"), p.alias("path"),
        year.alias("year"), month.alias("month"), day.alias("day"), hh.alias("hh"), mm.alias("mm"),
        filename.alias("filename"),
        F.concat_ws("/", region, site, p, filename).alias("record_id"),
        ts_local.alias("ts_local"), to_utc(ts_local, tz).alias("ts_utc")))


def tweet_parts(path, root: str, tz: str = "UTC") -> Column:
    """P3 + P4: struct(country, year, month, day, hh, mm, filename,
    record_id, ts_local, ts_utc); the tweet id is the file name."""
    d = relative_parts(path, root)
    n = F.size(d)
    hm = F.split(F.element_at(d, -2), "-", -1)
    filename = F.regexp_replace(F.element_at(d, -1), r".{1,4}\z", "")
    year, month, day = _int(F.element_at(d, -5)), _int(F.element_at(d, -4)), _int(F.element_at(d, -3))
    hh, mm = _int(F.get(hm, 0)), _int(F.get(hm, 1))
    ts_local = _local_ts(year, month, day, hh, mm)
    return F.when(n >= 6, F.struct(
        F.get(d, 0).alias("country"), year.alias("year"), month.alias("month"), day.alias("day"),
        hh.alias("hh"), mm.alias("mm"), filename.alias("filename"), filename.alias("record_id"),
        ts_local.alias("ts_local"), to_utc(ts_local, tz).alias("ts_utc")))


def parse_iso(col) -> Column:
    """P5: ISO text 'YYYY-MM-DDTHH:MM:SS[...]' -> timestamp to the second."""
    c = F.substring(_c(col), 1, 19)
    return F.try_to_timestamp(F.regexp_replace(c, "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def feature_key(path, root: str, legacy: bool = False) -> Column:
    """A key for one page across stages and versions.

    Default: region/site/path/name-without-last-suffix, stage folder left
    out; null for paths too short to hold a site (null never joins).
    ``legacy=True`` keeps the original rule: region and site dropped, every
    occurrence of the suffix text removed from the name, '' for bad paths."""
    d = relative_parts(path, root)
    n = F.size(d)
    if legacy:
        rest = F.slice(d, 4, F.greatest(n - 3, F.lit(1)))
        last = F.element_at(rest, -1)
        suf = F.element_at(F.split(last, r"\.", -1), -1)
        new_last = F.replace(last, suf, F.lit(""))
        key = F.array_join(F.concat(F.slice(rest, 1, F.size(rest) - 1), F.array(new_last)), "/")
        return F.when(n >= 4, key).otherwise(F.lit(""))
    stem = F.regexp_replace(F.element_at(d, -1), r"(?<=[^/])\.[^./]+\z", "")
    key = F.concat_ws("/", F.get(d, 0), F.get(d, 2), F.array_join(F.slice(d, 4, F.greatest(n - 4, F.lit(0))), "/"), stem)
    return F.when(n >= 4, F.regexp_replace(key, "/+", "/"))


def relative_to_absolute(col, root: str) -> Column:
    """P7: './x' (relative to ``root``) -> '{root}/x'."""
    return F.regexp_replace(_c(col), r"\A\./", _qr(root.rstrip("/")) + "/")


def absolute_to_relative(col, root: str) -> Column:
    """P7: '{root}/x' -> './x' (first occurrence)."""
    return F.regexp_replace(_c(col), r"\A(.*?)" + re.escape(root.rstrip("/")), "$1.")


def region_of(path, root: str, regions=REGIONS) -> Column:
    """The region folder right below ``root``, if it is a known region
    (exact folder match, so 'in' never matches 'int')."""
    r = F.regexp_extract(_c(path), r"\A" + re.escape(root.rstrip("/")) + r"/([^/]+)/", 1)
    return F.when(r.isin(list(regions)), r)


def site_of(path, root: str) -> Column:
    """The folder after the stage folder; null if missing or empty."""
    d = relative_parts(path, root)
    s = F.get(d, 2)
    return F.when(s != "", s)


# --- URLs ------------------------------------------------------------------

URL_RE = r"\A([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?\z"


def url_host(col) -> Column:
    """P9 on URLs: lower-case host without port or user."""
    auth = F.regexp_extract(_c(col), URL_RE, 2)
    return F.lower(F.regexp_replace(F.regexp_replace(auth, r"\A.*@", ""), r":[0-9]*\z", ""))


def url_path(col) -> Column:
    """Path part of a URL (query and fragment removed)."""
    return F.regexp_extract(_c(col), URL_RE, 3)


def crawl_time_key(path) -> Column:
    """Newest-first sort key from the yyyy/mm/dd-hh folders (sort
    ascending on it for newest first)."""
    m = r"/([0-9]{4})/([0-9]{2})/([0-9]{2})-([0-9]{2})"
    y, mo, d, h = (F.regexp_extract(_c(path), m, i).try_cast("long") for i in (1, 2, 3, 4))
    return -(((y * 100 + mo) * 100 + d) * 100 + h)
