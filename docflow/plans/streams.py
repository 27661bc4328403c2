"""Stream queries and polls; their oracle is the batch query's SQL (same result)."""

from docflow.plans.events import SQL as EV
from docflow.streaming import incremental as W

QUERIES = {"stream_hourly": W.stream_hourly, "stream_health": W.stream_health,
           "stream_latest": W.stream_latest, "stream_first": W.stream_first, "stream_quota": W.stream_quota,
           "stream_late": W.stream_late}

SQL = {
    "stream_hourly": EV["hourly_manifest"],
    "stream_health": """SELECT event_type AS stage, date_trunc('hour', ts) AS window_start, count(*) AS n
        FROM events GROUP BY ALL""",
    "stream_latest": EV["latest_version"],
    "stream_first": EV["first_seen"],
    "stream_quota": f"""SELECT event_id, event_type, ts,
        (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) // {W.POLL_QUOTA} AS poll FROM events""",
    "stream_late": f"""WITH e AS (SELECT event_type, ts, ((event_id % {W.LATE_FILES}) + {W.LATE_FILES}) % {W.LATE_FILES} AS file FROM events),
        m AS (SELECT file, max(ts) AS newest FROM e GROUP BY file),
        b AS (SELECT f.file, (SELECT max(newest) FROM m WHERE m.file < f.file) AS newest FROM m f),
        l AS (SELECT event_type, date_trunc('day', ts) AS day, coalesce(ts < b.newest - INTERVAL {W.LATE_DELAY}, false) AS late FROM e JOIN b USING (file))
        SELECT event_type, CAST(day AS TIMESTAMP) AS day, count(*) FILTER (WHERE NOT late) AS n, count(*) FILTER (WHERE late) AS n_late FROM l GROUP BY event_type, day""",
}
