"""Per-query shuffle volume from a Spark event log written by
``BENCH_EVENT_LOG=1 python bench.py``: shuffle bytes written, total task
time and task count, summed over the jobs tagged ``bench:<query>``.

    python tools/shuffle_report.py <event-log-dir-or-file>
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def load(path: str):
    """Events of a plain or rolling (v2, maybe zstd-compressed) event log."""
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-", "app-")))
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                lines = io.TextIOWrapper(reader, encoding="utf-8")
                for line in lines:
                    if line.strip():
                        yield json.loads(line)
        else:
            with open(f) as fh:
                for line in fh:
                    if line.strip():
                        yield json.loads(line)


def report(path: str) -> dict[str, dict[str, float]]:
    stage_query: dict[int, str] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for ev in load(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description", "")
            if desc.startswith("bench:"):
                for sid in ev.get("Stage IDs", []):
                    stage_query[sid] = desc[len("bench:"):]
        elif kind == "SparkListenerTaskEnd":
            q = stage_query.get(ev.get("Stage ID"))
            m = ev.get("Task Metrics") or {}
            if not q or not m:
                continue
            out[q]["shuffle_write_mb"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
            out[q]["task_s"] += m.get("Executor Run Time", 0) / 1e3
            out[q]["tasks"] += 1
    return out


def main():
    rep = report(sys.argv[1])
    print(f"{'query':18s} {'shuffle MB':>10s} {'task s':>7s} {'tasks':>6s}")
    for q, m in rep.items():
        print(f"{q:18s} {m['shuffle_write_mb']:10.2f} {m['task_s']:7.1f} {int(m['tasks']):6d}")


if __name__ == "__main__":
    main()
