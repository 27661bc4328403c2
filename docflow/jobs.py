"""spark-submit entry points for the original's loops.

    spark-submit --py-files docflow.zip docflow/jobs.py extract \\
        --root /share/html --manifests /share/run/new-html-files \\
        --out /share/tables/extracted --ledger /share/tables/ledger \\
        --checkpoint /share/checkpoints/extract [--region jp] [--poll '10 seconds']

    ... translate --extracted /share/tables/extracted --ledger /share/tables/ledger \\
        --to ja --out /share/tables/translated [--memory /share/tables/tm] [--poll '1 second' --checkpoint ...]

    ... index --translated /share/tables/translated --root /share/html \\
        --history /share/tables/index_history --run-id 1

    ... posts --manifests /share/run/new-html-files --to ja \\
        --out /share/tables/posts_ja --ledger /share/tables/ledger [--poll '10 seconds' --checkpoint ...]

    ... classify --extracted /share/tables/extracted --translated /share/tables/translated --root /share/html \\
        --out /share/classified --ledger /share/tables/ledger [--topic module:function]

    ... sentiment --classified /share/classified --root /share/html --scorer module:function \\
        --out /share/sentiment --ledger /share/tables/ledger

    ... health --ledger /share/tables/ledger --out /share/tables/health --run-id 1

Each job reads and writes tables on shared storage; a job killed at any
point can be started again: a run's results and ledger lines carry one
number, the ledger comes last, and a run that died before it is repeated under
the same number and replaces its own rows.  The translate function is the pass-through by
default; a deployment passes its own through ``--translator module:function``.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys

if __package__ in (None, ""):  # run as a script file: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docflow import constants as K  # noqa: E402


def _codes(spec: str | None):
    return {int(x) for x in spec.split(",") if x.strip()} if spec else None


def _translator(spec: str | None):
    if not spec:
        from docflow.operators.translate import passthrough
        return passthrough
    mod, fn = spec.split(":")
    return getattr(importlib.import_module(mod), fn)


def _finish(q, poll):
    if poll is not None:
        q.awaitTermination()


def run_extract(spark, a):
    from docflow.flows import extract_stream
    _finish(extract_stream(spark, a.manifests, a.root, a.out, a.ledger, a.checkpoint, days=a.days, quota=a.quota,
                           region=a.region, once=a.poll is None, interval=a.poll or "10 seconds"), a.poll)


def _need_checkpoint(a):
    if a.poll and not a.checkpoint:
        raise SystemExit("--poll needs --checkpoint")


def run_translate(spark, a):
    from docflow.flows import translate_stream
    _need_checkpoint(a)
    _finish(translate_stream(spark, a.extracted, a.out, a.ledger, a.checkpoint, a.to, quota=a.quota,
                             translate_fn=_translator(a.translator), memory_path=a.memory, once=a.poll is None,
                             interval=a.poll or "1 second", retry_status=_codes(a.retry_status),
                             manifest_path=a.manifest_out), a.poll)


def run_index(spark, a):
    from docflow.flows import index_flow
    from docflow.functions.paths import with_suffix
    from docflow.sources.files import read_named_files
    tr = spark.read.parquet(a.translated)
    # only the .url sidecars of the translated pages, read on the executors
    want = tr.select("page_path").distinct().withColumn("_url_path", with_suffix("page_path", ".url"))
    urls = read_named_files(want, "_url_path", "_url", "_m").select(
        "page_path", F.regexp_replace("_url", r"\A\s+|\s+\z", "").alias("url")).filter(F.col("url").isNotNull())
    newest, first, skipped = index_flow(tr, urls, a.root, tz=a.tz)
    if a.ledger:
        from docflow.sinks.tables import append_ledger, next_batch
        number = next_batch(spark, a.ledger, "index")
    newest.write.mode("errorifexists").parquet(f"{a.history}/newest-{a.run_id}")
    first.write.mode("errorifexists").parquet(f"{a.history}/first-{a.run_id}")
    skipped.select("page_path").write.mode("errorifexists").parquet(f"{a.history}/skipped-{a.run_id}")
    if a.ledger:      # K10: what the index holds now
        append_ledger(spark.read.parquet(f"{a.history}/newest-{a.run_id}"), a.ledger, "index", extra=["to_lang"], batch_id=number)


def run_posts(spark, a):
    """The short-post loop: post pages listed in manifests (lines starting
    with ``--prefix``), not yet in the ledger, first and last ``--n`` in
    arrival order, translated one part each."""
    from docflow.flows import posts_stream
    _need_checkpoint(a)
    _finish(posts_stream(spark, a.manifests, a.prefix, a.out, a.ledger, a.checkpoint, a.to, n=a.n,
                         translate_fn=_translator(a.translator), once=a.poll is None, interval=a.poll or "10 seconds"), a.poll)


def _function(spec: str):
    mod, fn = spec.split(":")
    return getattr(importlib.import_module(mod), fn)


def run_classify(spark, a):
    from docflow.flows import classify_stream
    _need_checkpoint(a)
    _finish(classify_stream(spark, a.extracted, a.translated, a.root, a.out, a.ledger, a.checkpoint,
                            topic=_function(a.topic) if a.topic else None, once=a.poll is None, interval=a.poll or "10 seconds"), a.poll)


def run_sentiment(spark, a):
    from docflow.flows import sentiment_stream
    _need_checkpoint(a)
    _finish(sentiment_stream(spark, a.classified, a.root, a.out, a.ledger, _function(a.scorer), a.checkpoint,
                             once=a.poll is None, interval=a.poll or "1000 seconds"), a.poll)


def run_health(spark, a):
    """Per stage the last item, counts, failures and a stale flag
    (what the original's process watcher checked), written as a table."""
    from docflow.operators.ledger import stage_health
    led = spark.read.parquet(a.ledger)
    rep = stage_health(led, stale_after=a.stale_after)
    rep.write.mode("errorifexists").parquet(f"{a.out}/health-{a.run_id}")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="docflow.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    e = sub.add_parser("extract")
    e.add_argument("--root", required=True)
    e.add_argument("--manifests", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--ledger", required=True)
    e.add_argument("--checkpoint", help="clock checkpoint folder (with --poll)", required=True)
    e.add_argument("--region")
    e.add_argument("--days", type=int, default=K.EXTRACT_DAY_WINDOW)
    e.add_argument("--quota", type=int, default=K.EXTRACT_SITE_QUOTA)
    e.add_argument("--poll", help="keep polling (e.g. '10 seconds') instead of one pass")
    t = sub.add_parser("translate")
    t.add_argument("--extracted", required=True)
    t.add_argument("--ledger", required=True)
    t.add_argument("--to", required=True, choices=sorted(K.ROUTE_SOURCES))
    t.add_argument("--out", required=True)
    t.add_argument("--memory")
    t.add_argument("--quota", type=int, default=K.TRANSLATE_SITE_QUOTA)
    t.add_argument("--translator")
    t.add_argument("--poll", help="keep polling (e.g. '1 second') instead of one pass")
    t.add_argument("--manifest-out", dest="manifest_out", help="hourly manifests of new targets")
    t.add_argument("--retry-status", dest="retry_status", help="codes to try again, e.g. 3,8")
    t.add_argument("--checkpoint", help="stream checkpoint folder (with --poll)")
    i = sub.add_parser("index")
    i.add_argument("--translated", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--history", required=True)
    i.add_argument("--run-id", dest="run_id", required=True)
    i.add_argument("--tz", default="UTC")
    i.add_argument("--ledger", help="ledger for the indexed items")
    p = sub.add_parser("posts")
    p.add_argument("--manifests", required=True)
    p.add_argument("--prefix", default=K.POST_PATH_PREFIX)
    p.add_argument("--to", required=True, choices=sorted(K.ROUTE_SOURCES))
    p.add_argument("--out", required=True)
    p.add_argument("--ledger", required=True)
    p.add_argument("--n", type=int, default=K.TWEET_HEAD_TAIL)
    p.add_argument("--translator")
    p.add_argument("--poll", help="keep polling (e.g. '10 seconds') instead of one pass")
    p.add_argument("--checkpoint", help="stream checkpoint folder (with --poll)")
    c = sub.add_parser("classify")
    c.add_argument("--extracted", required=True)
    c.add_argument("--translated", required=True)
    c.add_argument("--root", required=True)
    c.add_argument("--topic", help="module:function that adds a topic column")
    s = sub.add_parser("sentiment")
    s.add_argument("--classified", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--scorer", required=True, help="module:function that adds a sentiment column to titles")
    for x in (c, s):
        x.add_argument("--out", required=True)
        x.add_argument("--ledger", required=True)
        x.add_argument("--poll", help="keep polling instead of one pass")
        x.add_argument("--checkpoint", help="clock checkpoint folder (with --poll)")
    h = sub.add_parser("health")
    h.add_argument("--ledger", required=True)
    h.add_argument("--out", required=True)
    h.add_argument("--run-id", dest="run_id", required=True)
    h.add_argument("--stale-after", dest="stale_after", default="2 hours")
    return ap


def main(argv=None) -> int:
    from docflow.session import build_session
    a = parser().parse_args(argv)
    spark = build_session(app=f"docflow-{a.job}", cluster=True)
    jobs = {"extract": run_extract, "translate": run_translate, "index": run_index, "posts": run_posts,
            "classify": run_classify, "sentiment": run_sentiment, "health": run_health}
    jobs[a.job](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
