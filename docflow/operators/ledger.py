"""Work lists from processed-item ledgers.

A ledger is an append-only table of processed items (item key, stage,
status, processed_at).  "What is left to do" is an anti-join against it,
"what is ready" semi-joins; all joins are on unique item keys, so no key is
hot.  Quotas and limits keep an explicit order with a unique tie-break.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.constants import STATUS_OK


def _cols(x):
    return [x] if isinstance(x, (str, Column)) else list(x)


def ok_items(ledger: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Keys whose (last) ledger line says success."""
    return ledger.filter(F.col(status) == STATUS_OK).select(key).distinct()


def unprocessed(items: DataFrame, ledger: DataFrame, key: str, ledger_key: str | None = None,
                retry_status=None, status: str = "status") -> DataFrame:
    """Items with no ledger line.  ``retry_status`` (e.g. {3, 8}) lets
    items whose ledger lines all carry those codes be tried again (the
    original never retried).  Item keys are usually unique paths; a key that
    many items share is split by adaptive execution."""
    lk = ledger_key or key
    led = ledger
    if retry_status:
        # a line without a status is not one of the codes: its item stays processed
        led = led.filter(~F.coalesce(F.col(status).isin(list(retry_status)), F.lit(False)))
    led = led.select(F.col(lk).alias("_lk"))
    return items.join(led, items[key] == led["_lk"], "left_anti")


def ready_set(first: DataFrame, second: DataFrame, third: DataFrame, done: DataFrame,
              key: str, order=None) -> DataFrame:
    """In ``first`` and ``second`` and ``third``, not in ``done``
    (all on ``key``), newest first when ``order`` is given."""
    out = first
    for other in (second, third):
        o = other.select(F.col(key).alias("_k"))
        out = out.join(o, out[key] == o["_k"], "left_semi")
    d = done.select(F.col(key).alias("_k"))
    out = out.join(d, out[key] == d["_k"], "left_anti")
    if order is not None:
        out = out.orderBy(*_cols(order))
    return out


#: Buckets of input partitions in which a limit is taken first.
FAN_IN = 64


def site_quota(df: DataFrame, site, order, n: int, rank: str = "rank",
               buckets: int = FAN_IN) -> DataFrame:
    """A1: at most ``n`` items per site (a column or a list of them, e.g.
    region and site), in ``order`` (which must end in a unique column).

    Planned as WindowGroupLimit: each task keeps its own top ``n`` per site
    before the shuffle, so a hot site moves ``n`` rows per task.  The limit
    is taken in two levels (site and a bucket of input partitions, then
    site), so the task finishing a hot site reads ``buckets * n`` rows
    instead of ``partitions * n``."""
    order = _cols(order)
    if buckets > 1:
        df = df.withColumn("_b", F.spark_partition_id() % buckets)
        w1 = Window.partitionBy(*_cols(site), "_b").orderBy(*order)
        df = df.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n).drop("_r", "_b")
    w = Window.partitionBy(*_cols(site)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("long")).filter(F.col(rank) <= n)


def top_k(df: DataFrame, order, k: int, buckets: int = FAN_IN) -> DataFrame:
    """The first ``k`` rows in ``order`` (a unique ordering), in two levels:
    top ``k`` per bucket of input partitions (limited per task before the
    shuffle; ``session.RUNTIME_CONF`` lifts Spark's bound of 1,000 for that),
    then top ``k`` of those.  One task never reads more than ``buckets * k``
    rows."""
    order = _cols(order)
    if buckets > 1:
        w = Window.partitionBy(F.spark_partition_id() % buckets).orderBy(*order)
        df = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")
    return df.orderBy(*order).limit(k)


def head_tail(df: DataFrame, order, n: int, buckets: int = FAN_IN) -> DataFrame:
    """The first ``n`` and the last ``n`` items in ``order``, once each."""
    asc = [F.col(c) if isinstance(c, str) else c for c in _cols(order)]
    desc = [c.desc() for c in asc]
    return top_k(df, asc, n, buckets).unionByName(top_k(df, desc, n, buckets)).distinct()


def backlog(items: DataFrame, ledger: DataFrame, key: str, by) -> DataFrame:
    """A3: count of unprocessed items per group (partial counts per task,
    then a small shuffle)."""
    return unprocessed(items, ledger, key).groupBy(*_cols(by)).agg(F.count(F.lit(1)).alias("n"))


def status_totals(ledger: DataFrame, by) -> DataFrame:
    """Ledger lines per group and status."""
    return ledger.groupBy(*_cols(by)).agg(F.count(F.lit(1)).alias("n"))


def union_all(frames) -> DataFrame:
    """A10: bag union of many inputs with the same columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newest_first(df: DataFrame, order) -> DataFrame:
    """A5: reverse of the arrival order (``order`` ascending = arrival)."""
    return df.orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in _cols(order)])


def stage_health(ledger: DataFrame, stage: str = "stage", ts: str = "processed_at",
                 status: str = "status", stale_after: str = "2 hours") -> DataFrame:
    """A4: per stage the last item time, item and failure counts, and a
    stale flag when the stage's last item is older than ``stale_after``
    before the newest item of any stage (re-aim of the process watcher)."""
    per = ledger.groupBy(stage).agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"),
                                    F.count_if(F.col(status) != STATUS_OK).alias("n_failed"))
    newest = F.max("last_ts").over(Window.partitionBy())   # one row per stage
    return per.withColumn("stale", F.col("last_ts") < newest - F.expr(f"INTERVAL {stale_after}"))


def unscored_records(records: DataFrame, ledger: DataFrame, link: str = "link",
                     ledger_key: str = "page_path") -> DataFrame:
    """Classified records (with an absolute ``link`` from
    ``sources.files.classified_view``) whose link is not in the ledger."""
    return unprocessed(records.filter(F.col(link).isNotNull()), ledger, link, ledger_key)
