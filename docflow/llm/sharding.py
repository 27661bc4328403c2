"""Shuffled shards by a two-pass external shuffle.

Pass one scatters the records uniformly: a seeded hash of a record's id and
text deals it to one of ``n_buckets`` buckets, each small enough to be held
in memory by one task (``bucket_bytes`` of text on average).  Pass two reads
each bucket whole, puts it into a fixed order, Fisher-Yates shuffles it with
draws from the seed and the bucket's number, and writes it.  The buckets one
after another are one random order of all records, and shard ``s`` of ``S``
takes the places from ``s * n // S`` to before ``(s + 1) * n // S``: counts are
at most one apart, and a slot is the place within the shard.

Texts go through one exchange and one table; bucket totals are one row a
bucket.  ``write_shards`` writes the shards as files in slot order, without
another exchange.

Nothing depends on how the input lies in files, with one exception: where
equal copies of a record (id and text) fill more than a quarter of a bucket,
they would make that bucket too large, so each copy is dealt by its place in
its input task as well.  The input should then be a table, read alike by a
repeated task.

Defined cases: a null text counts as empty and stays null in the shards; null
ids are ids like others; equal texts are records of their own and are not kept
together; rows that repeat id and text may change places among themselves;
a text larger than a bucket is one record of one bucket; an empty table
gives empty shards; input columns pass unchanged, and where one is called ``shard``
or ``slot``, the result's column of that name gets underscores at its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docflow.llm.common import materialize, text_of

SEED = 20_240_613
BUCKET_BYTES = 64 << 20
#: Bytes a record counts besides its text.
ROW_BYTES = 64
_GAMMA = 0x9E3779B97F4A7C15


def draws(seed: int, n: int) -> np.ndarray:
    """``n`` numbers of 53 random bits, in [0, 1): SplitMix64, so they are
    the same in every release of every library."""
    with np.errstate(over="ignore"):
        z = np.uint64(seed & (2**64 - 1)) + np.uint64(_GAMMA) * np.arange(1, n + 1, dtype=np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) / float(1 << 53)


def fisher_yates(n: int, seed: int) -> list[int]:
    """A random order of ``range(n)``: from the last place down, each is
    swapped with one drawn from those up to it."""
    order = list(range(n))
    pick = (draws(seed, n) * np.arange(n, 0, -1)).astype(np.int64).tolist()
    for k in range(n - 1):
        i = n - 1 - k
        j = pick[k]
        order[i], order[j] = order[j], order[i]
    return order


def totals(docs: DataFrame, id_col: str, text_col: str, bucket_bytes: int, least: int) -> tuple[int, int, DataFrame]:
    """(records, buckets, hashes of records with many equal copies)."""
    text = text_of(text_col)
    sums = (docs.select(F.xxhash64(F.col(id_col), text).alias("h"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"))
            .groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    sums = materialize(sums, "shard-records")
    n, size = sums.agg(F.sum("n"), F.sum("size")).first()
    n, size = n or 0, size or 0
    buckets = max(least, -(-size // bucket_bytes))
    # at most 4 * buckets hashes can pass: their copies fill over a quarter of a bucket each
    return n, buckets, sums.filter((F.col("size") * 4 > bucket_bytes) & (F.col("n") > 1)).select(F.col("h").alias("__docflow_hot"))


def shuffle_buckets(seed: int):
    """Pass two over one partition, which is one bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        bucket = table.column("__docflow_bucket")[0].as_py()
        fixed = np.argsort(table.column("__docflow_h").to_numpy(), kind="stable")
        order = fixed[fisher_yates(table.num_rows, seed ^ (bucket * _GAMMA))]
        table = table.drop_columns(["__docflow_h"])
        for at in range(0, len(order), 1000):
            part = table.take(pa.array(order[at:at + 1000])).append_column("__docflow_place", pa.array(np.arange(at, min(at + 1000, len(order)), dtype=np.int64)))
            yield from part.combine_chunks().to_batches()
    return run


def shuffled_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long), from a written
    table that holds the buckets in their shuffled order."""
    # inside, columns have names by their place, so that none can clash
    names = docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    n, buckets, hot = totals(docs, id_col, text_col, bucket_bytes, shards)
    h = F.xxhash64(F.col(id_col), text_of(text_col))
    marked = docs.withColumn("__docflow_h", h).join(F.broadcast(hot), F.col("__docflow_h") == F.col("__docflow_hot"), "left")
    salt = F.when(F.col("__docflow_hot").isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "__docflow_h", salt), F.lit(buckets).cast("long"))
    dealt = (marked.withColumn("__docflow_bucket", bucket).drop("__docflow_hot")
             .repartitionById(buckets, F.col("__docflow_bucket").cast("int")))
    kept = [f for f in dealt.schema if f.name != "__docflow_h"]
    placed = dealt.mapInArrow(shuffle_buckets(seed), StructType([*kept, StructField("__docflow_place", LongType())]))
    placed = materialize(placed, "shards")
    # one row a bucket: where it starts in the whole order
    counts = placed.groupBy("__docflow_bucket").agg(F.count(F.lit(1)).alias("__docflow_n"))
    before = F.sum("__docflow_n").over(Window.orderBy("__docflow_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("__docflow_bucket").alias("__docflow_b"), F.coalesce(before, F.lit(0)).alias("__docflow_start"))
    at = F.col("__docflow_start") + F.col("__docflow_place")
    # the shard whose range holds a place: the largest s with s * n // shards <= place
    shard = F.expr(f"((__docflow_at + 1) * {shards} - 1) div {max(n, 1)}")
    out = (placed.join(F.broadcast(starts), F.col("__docflow_bucket") == F.col("__docflow_b")).withColumn("__docflow_at", at)
           .withColumn("shard", shard.cast("int"))
           .withColumn("slot", F.col("__docflow_at") - F.expr(f"(shard * {n}L) div {shards}")))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
                      *[F.col(c).alias(unused(c, names)) for c in ("shard", "slot")])


def unused(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def write_shards(shards: DataFrame, path: str) -> None:
    """Writes ``shard=<s>`` folders, without another exchange: a task's
    rows are put in order, so each file ascends in its column ``slot``."""
    shards.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
