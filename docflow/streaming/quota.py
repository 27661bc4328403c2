"""A quota per site and poll as keyed state with timers.

Each site's waiting items are a queue in the state store, cut into pages, so a
poll reads and writes a few pages however long the queue is.  Polls have a
fixed distance in event time, from a given start on.  A timer per site with waiting items
fires when the watermark passes its next poll; if it has passed several, as
many polls are made at once, each with its own number and quota.  Leftovers
stay in the state, so a restart from the checkpoint neither repeats nor loses
an item, and nothing is read twice.

A site is one key, as its polls depend on each other.  A task holds the items
that one micro-batch brings for a site (bounded by the files of a trigger) and
otherwise one page.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampNTZType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
SPREAD = 4     # partitions a site, so that sites seldom share one
PAGE = 500
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Pages:
    """Items in order in a map of pages ``head`` … ``tail``: added at the end,
    taken from the front (oldest first) or from the end (newest first)."""

    def __init__(self, pages, meta, page: int):
        self.pages, self.meta, self.page = pages, meta, page
        self.head, self.tail, self.poll, self.timer = meta.get() if meta.exists() else (0, 0, 0, False)

    def __bool__(self) -> bool:
        return self.head < self.tail

    def save(self) -> None:
        self.meta.update((self.head, self.tail, self.poll, self.timer))

    def _get(self, at: int) -> list[str]:
        return json.loads(self.pages.getValue((at,))[0])

    def _put(self, at: int, items: list[str]) -> None:
        self.pages.updateValue((at,), (json.dumps(items),))

    def add(self, items: list[str]) -> None:
        if items and self and len(last := self._get(self.tail - 1)) < self.page:
            self.tail -= 1
            items = last + items
        for at in range(0, len(items), self.page):
            self._put(self.tail, items[at:at + self.page])
            self.tail += 1

    def take(self, n: int, newest: bool) -> list[str]:
        out: list[str] = []
        while len(out) < n and self:
            at = self.tail - 1 if newest else self.head
            items, more = self._get(at), n - len(out)
            out += items[::-1][:more] if newest else items[:more]
            rest = items[:-more] if newest else items[more:]
            if rest:
                self._put(at, rest)
            else:
                self.pages.removeKey((at,))
                self.head, self.tail = (self.head, self.tail - 1) if newest else (self.head + 1, self.tail)
        return out


class Quota(StatefulProcessor):
    def __init__(self, n: int, gap_ms: int, start_ms: int, newest: bool, page: int = PAGE):
        self.n, self.gap, self.start, self.newest, self.page = n, gap_ms, start_ms, newest, page

    def next_poll(self, now: int) -> int:
        return self.start if now < self.start else now + self.gap - (now - self.start) % self.gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "at long", "items string")
        self.meta = handle.getValueState("meta", "head long, tail long, poll long, timer boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        queue = Pages(self.pages, self.meta, self.page)
        queue.add([item for _, item in sorted(zip(new["order_key"], new["item"]))])
        if not queue.timer:
            self.handle.registerTimer(self.next_poll(max(timerValues.getCurrentWatermarkInMs(), int(new["at_ms"].min()))))
            queue.timer = True
        queue.save()
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        queue = Pages(self.pages, self.meta, self.page)
        at, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        while queue and at <= now:
            items = queue.take(self.n, self.newest)
            yield pd.DataFrame({"item": items, "poll": queue.poll, "polled_ms": at})
            queue.poll += 1
            at += self.gap
        queue.timer = bool(queue)
        if queue:
            self.handle.registerTimer(at)
        queue.save()

    def close(self) -> None:
        pass


def quota_stream(stream: DataFrame, site: str, ts: str, order: list[str], n: int, gap_ms: int, start_ms: int = 0,
                 newest: bool = True, delay: str = "0 seconds", page: int = PAGE) -> DataFrame:
    """The rows of ``stream``, each when its site's quota lets it through, with
    ``poll`` (a site's polls counted from 0) and ``polled_ms`` (event time).

    Of the rows that wait, the newest (else the oldest) to arrive go first;
    rows of one micro-batch arrive in ``order`` (whole numbers or times).  A null
    site is a site.  The stream has a column ``__tick`` (``with_ticks``); a row
    with true there only moves the watermark."""
    from docflow.streaming.incremental import event_time
    rows, _ = event_time(stream, ts)
    rows = rows.withWatermark(ts, delay)
    kept = StructType([f for f in stream.schema if f.name != "__tick"])
    number = lambda c: (F.unix_micros(F.col(c).cast("timestamp")) if isinstance(stream.schema[c].dataType, TimestampNTZType)
                        or stream.schema[c].dataType.typeName() == "timestamp" else F.col(c).cast("long"))
    # times and numbers as text of one width, so that they sort as numbers do
    text = lambda c: F.lpad((F.coalesce(number(c), F.lit(0)).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 21, "0")
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in kept]
    item = F.when(F.coalesce("__tick", F.lit(False)), None).otherwise(F.to_json(F.struct(*fields), {**_TIMES, "ignoreNullFields": "false"}))
    waiting = rows.select(F.to_json(F.struct(F.col(site).alias("s"))).alias("key"), F.col(ts).alias("at"),
                          F.coalesce(F.unix_millis(F.col(ts)), F.lit(0)).alias("at_ms"), F.concat(*[text(c) for c in order]).alias("order_key"), item.alias("item")).filter("item is not null")
    out = waiting.groupBy("key").transformWithStateInPandas(
        Quota(n, gap_ms, start_ms, newest, page), outputStructType="item string, poll long, polled_ms long", outputMode="append", timeMode="eventTime")
    return out.select(F.from_json("item", kept, _TIMES).alias("r"), "poll", "polled_ms").select("r.*", "poll", "polled_ms")


def with_ticks(schema: StructType) -> StructType:
    """The schema of a source that also carries ticks: rows with ``__tick``
    true and a time, which stand for no item."""
    return StructType([*schema, StructField("__tick", BooleanType())])


def run_quota(stream: DataFrame, out: str, checkpoint: str, sites: int | None = None, **quota):
    """Runs ``quota_stream`` over what is there now; results go to ``out`` by
    batch.  The state is held in RocksDB.  ``sites``: about how many there are;
    a batch commits each partition's store, with keys or without, so few sites
    get no more than ``SPREAD`` partitions each (a restart keeps the first run's
    number)."""
    from docflow.streaming.incremental import append_batch, run_batches
    conf = stream.sparkSession.conf
    held = {PROVIDER: ROCKSDB}
    if sites:
        held[PARTITIONS] = str(min(int(conf.get(PARTITIONS)), SPREAD * sites))
    before = {k: conf.get(k, None) for k in held}
    for k, v in held.items():
        conf.set(k, v)
    try:
        return run_batches(quota_stream(stream, **quota), lambda b, i: append_batch(b, out, i), checkpoint)
    finally:
        for k, v in before.items():
            conf.set(k, v) if v else conf.unset(k)
