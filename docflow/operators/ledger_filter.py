"""Anti-joins against a ledger too large to read at every poll.

A ledger is kept as two tables below one path:

- ``lines``: its lines, in folders by day and bucket (a hash of the key);
- ``filters``: a Bloom filter a day, as rows (slot, bits).  A key has one slot
  and sets ``HASHES`` of the slot's 64 bits, so a look-up is one equi-join on
  the slot, and filters of several days or batches are joined by ``bit_or``.

``unprocessed`` looks the items up in the filters.  Those that the filter
rules out are done with; only for the others the lines are read, and of these
only the buckets the others fall into.  The answer is that of the plain
anti-join whatever the filter says too much.

Defined cases: an item with a null key is never in a ledger; a line with a
null key matches nothing; keys that repeat are one key in the filter and in
the join, and combine before the shuffle; a missing or empty ledger leaves all
items.  Keys are compared by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.ranking import written

#: Slots of 64 bits a filter has.  Four keys a slot let about 1 in 180 other
#: keys through, so 4 million slots serve windows of some 16 million lines.
SLOTS = 1 << 22
HASHES = 4
BUCKETS = 64
#: Tasks that share a day and bucket while it is written.
WRITERS = 8


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def _mask(key: Column) -> Column:
    """The bits that a key sets in its slot: ``HASHES`` pieces of six bits of a second hash."""
    other = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        piece = F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), piece))
    return mask


def append_lines(lines: DataFrame, path: str, batch_id: int, key: str, day: str = "day",
                 slots: int = SLOTS, buckets: int = BUCKETS) -> None:
    """Appends ``lines`` (key, day and further columns) as batch ``batch_id``;
    a batch that is repeated replaces itself.  ``slots`` (a multiple of
    ``buckets``) and ``buckets`` stay those of the ledger's first batch.

    The filter is written first: a run that dies in between leaves a filter
    that says yes too often, never one that misses a line."""
    if slots % buckets:
        raise ValueError("slots must be a multiple of buckets")
    k = F.col(key).cast("string")
    rows = lines.withColumn("slot", _slot(k, slots)).withColumn("day", F.col(day)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    bits = rows.filter(k.isNotNull()).groupBy("day", "batch_id", "slot").agg(F.bit_or(_mask(k)).alias("bits"))
    out = rows.withColumn("bucket", F.col("slot") % buckets).drop("slot")
    dealt = out.withColumn("_writer", F.spark_partition_id() % WRITERS).repartition("day", "bucket", "_writer").drop("_writer")
    for name, df, by in (("filters", bits, ["day", "batch_id"]), ("lines", dealt, ["day", "bucket", "batch_id"])):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{path}/{name}")


def _window(df: DataFrame, since) -> DataFrame:
    return df if since is None else df.filter(F.col("day") >= F.lit(since))


def read_lines(spark: SparkSession, path: str, since=None, buckets: list[int] | None = None) -> DataFrame:
    """The ledger's lines; ``since`` (a day) and ``buckets`` choose folders."""
    lines = _window(spark.read.parquet(f"{path}/lines"), since)
    return lines if buckets is None else lines.filter(F.col("bucket").isin(buckets))


def possible(items: DataFrame, path: str, key: str, since=None, slots: int = SLOTS, buckets: int = BUCKETS) -> DataFrame:
    """The different keys of ``items`` (as ``k``, with their ``bucket``) that
    the filters of the days from ``since`` on do not rule out."""
    spark = items.sparkSession
    words = _window(spark.read.parquet(f"{path}/filters"), since).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    keys = items.select(F.col(key).cast("string").alias("k")).filter("k IS NOT NULL").distinct()
    probes = keys.select("k", _slot(F.col("k"), slots).alias("slot"), _mask(F.col("k")).alias("mask"))
    return probes.join(words, "slot").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")) \
        .select("k", (F.col("slot") % buckets).alias("bucket"))


def unprocessed(items: DataFrame, path: str, key: str, since=None, slots: int = SLOTS, buckets: int = BUCKETS) -> DataFrame:
    """J1 against a ledger written by ``append_lines``: the rows of ``items``
    whose key has no line of day ``since`` or later (any day if None).

    The keys that pass the filter are written once; the driver sees only
    which of the ``buckets`` buckets they are in."""
    from docflow.sinks.tables import read_if_exists
    spark = items.sparkSession
    if read_if_exists(spark, f"{path}/lines") is None or read_if_exists(spark, f"{path}/filters") is None:
        return items
    maybe = written(possible(items, path, key, since, slots, buckets), "ledger-maybe")
    used = sorted(r.bucket for r in maybe.select("bucket").distinct().collect())    # at most ``buckets`` numbers
    held = read_lines(spark, path, since, used).select(F.col(key).cast("string").alias("k")).distinct()
    seen = maybe.join(held, "k", "left_semi").select(F.col("k").alias("_seen"))
    return items.join(seen, F.col(key).cast("string") == F.col("_seen"), "left_anti")
