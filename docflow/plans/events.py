"""Queries over ``events`` (and ``conversations``): versions, limits,
hourly manifest, stage health, JSON sidecar fields, short posts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from docflow import constants as K
from docflow.functions import text as T
from docflow.functions.similarity import text_overlap
from docflow.operators import ledger as L
from docflow.operators import ledger_filter
from docflow.operators.latest import first_version, latest_version
from docflow.plans import sqlparts as S
from docflow.plans.common import read
from docflow.session import scratch_path
from docflow.sinks.commits import merge_newest, read_newest

FAIL_VALUE = 200.0     # an event with a larger value counts as a failed item
STALE_AFTER = "1 hour"  # a stage whose last item is older than this is flagged


def q_two_ended(spark, sf):
    """First and last 1000 events in arrival order, once each."""
    e = read(spark, sf, "events").select("event_id", "ts")
    return L.head_tail(e, ["ts", "event_id"], K.TWEET_HEAD_TAIL)


def q_latest_version(spark, sf):
    """K6: newest event per user (ties: earliest arrival)."""
    e = read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_version(e, "user_id", "ts", "event_id")


def q_newest_table(spark, sf):
    """K6 kept up by batches: four batches of events, each with versions older
    and newer than those before it, merged into a table of hash buckets."""
    e = read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    root = scratch_path(spark, f"newest/{uuid.uuid4().hex}")
    for k in range(4):
        merge_newest(e.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k), root, k, "user_id", "ts", "event_id", buckets=16)
    held = read_newest(spark, root)
    return e.limit(0) if held is None else held.select(e.columns)


def q_ledger_filter(spark, sf):
    """J1 through a ledger with a Bloom filter a day: the events are written
    as ledger lines in three batches; the kinds of event each user has had
    without one in the last two days, with their number."""
    e = read(spark, sf, "events").withColumn("day", F.to_date("ts")).withColumn("item", F.concat_ws("/", "user_id", "event_type"))
    root = scratch_path(spark, f"ledger/{uuid.uuid4().hex}")
    for k in range(3):
        lines = e.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).select("item", "event_id", "day")
        ledger_filter.append_lines(lines, root, k, "item", buckets=16)
    last = e.agg(F.max("day")).first()[0]
    items = e.groupBy("user_id", "event_type", "item").agg(F.count(F.lit(1)).alias("n"))
    since = None if last is None else last - dt.timedelta(days=1)
    return ledger_filter.unprocessed(items, root, "item", since, buckets=16).drop("item")


def q_first_seen(spark, sf):
    """K7: first arrival per user, later ones refused."""
    e = read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return first_version(e, "user_id", "event_id")


def q_hourly_manifest(spark, sf):
    """K5: items per output hour (minutes forced to 00)."""
    e = read(spark, sf, "events")
    return (e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_stage_health(spark, sf):
    """A4: per stage the last item time, items, failures and a stale flag
    (last item older than STALE_AFTER before the newest item overall)."""
    e = read(spark, sf, "events")
    per = e.groupBy(F.col("event_type").alias("stage")).agg(
        F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") > FAIL_VALUE).alias("n_failed"))
    # The newest item overall is the max of the per-stage maxima; ``per``
    # has one row per stage, so this window runs over a handful of rows.
    newest = F.max("last_ts").over(Window.partitionBy())
    return per.withColumn("stale", F.col("last_ts") < newest - F.expr(f"INTERVAL {STALE_AFTER}"))


def q_json_field(spark, sf):
    """One field of a JSON sidecar; null for broken JSON."""
    e = read(spark, sf, "events").select("event_id", "props")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"))


def q_post_prepare(spark, sf):
    """Short-post flow before translation: F7 empty check (status 1), X8
    guard, X9 newline runs."""
    c = read(spark, sf, "conversations")
    g = T.guard_tags("text")
    return c.select("conv_id", "turn",
                    F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 1).otherwise(0).alias("status"),
                    F.md5(g).alias("guarded_md5"),
                    F.length(T.leading_newlines("text")).cast("long").alias("lead_nl"),
                    F.length(T.trailing_newlines("text")).cast("long").alias("trail_nl"))


def q_turn_overlap(spark, sf):
    """J6 on a natural pair: each turn against the previous turn of its
    conversation, joined on the unique (conv_id, turn) key (a hot
    conversation spreads over tasks; no window, no pairs)."""
    c = read(spark, sf, "conversations").select("conv_id", "turn", "text")
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prev_text"))
    j = c.join(prev, ["conv_id", "turn"], "inner")
    return j.select("conv_id", "turn", F.round(text_overlap("text", "prev_text"), 6).alias("overlap"))


QUERIES = {
    "two_ended": q_two_ended, "latest_version": q_latest_version, "newest_table": q_newest_table, "ledger_filter": q_ledger_filter, "first_seen": q_first_seen,
    "hourly_manifest": q_hourly_manifest, "stage_health": q_stage_health, "json_field": q_json_field,
    "post_prepare": q_post_prepare, "turn_overlap": q_turn_overlap,
}

_q = S.q
_text_overlap = S.text_overlap


_NEWEST = """SELECT user_id, event_id, ts, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id ASC) = 1"""

SQL = {
    "two_ended": f"""SELECT * FROM (SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT {K.TWEET_HEAD_TAIL})
        UNION SELECT * FROM (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT {K.TWEET_HEAD_TAIL})""",
    "latest_version": _NEWEST,
    "newest_table": _NEWEST,
    "ledger_filter": """SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL
        HAVING concat_ws('/', user_id, event_type) NOT IN (
            SELECT concat_ws('/', user_id, event_type) FROM events
            WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 1)""",
    "first_seen": """SELECT user_id, event_id, ts, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "hourly_manifest": "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL",
    "stage_health": f"""SELECT event_type AS stage, max(ts) AS last_ts, count(*) AS n,
        count(*) FILTER (WHERE value > {FAIL_VALUE}) AS n_failed,
        max(ts) < (SELECT max(ts) FROM events) - INTERVAL {STALE_AFTER} AS stale
        FROM events GROUP BY event_type""",
    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "post_prepare": f"""SELECT conv_id, turn, CASE WHEN coalesce(length(text), 0) = 0 THEN 1 ELSE 0 END AS status,
        md5(regexp_replace(text, {_q(T.GUARD_PATTERN)}, ' ｟\\0 ｠ ', 'g')) AS guarded_md5,
        length(regexp_extract(text, {_q(chr(92) + 'A(' + chr(92) + 'n*)')}, 1)) AS lead_nl,
        length(regexp_extract(regexp_replace(text, {_q(chr(92) + 'A' + chr(92) + 'n*')}, ''), {_q('(' + chr(92) + 'n*)' + chr(92) + 'z')}, 1)) AS trail_nl
        FROM conversations""",
    "turn_overlap": f"""SELECT c.conv_id, c.turn, round({_text_overlap('c.text', 'p.text')}, 6) AS overlap
        FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn + 1 = c.turn""",
}
