"""Shards against a plain shuffle by the same hashes, and their defined cases."""

import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from docflow.llm import sharding

DOCS = "doc_id long, text string, size string, at string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", None) for i, t in rows], DOCS)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def h_of(i, text):
    seed = 42
    if i is not None:
        seed = xxhash.xxh64(struct.pack("<q", i), seed=seed).intdigest()
    return signed(xxhash.xxh64((text or "").encode(), seed=seed).intdigest())


def brute(rows, shards, bucket_bytes, seed=sharding.SEED):
    size = sum(len((t or "").encode()) + sharding.ROW_BYTES for _, t in rows)
    n_buckets = max(shards, -(-size // bucket_bytes))
    buckets = [[] for _ in range(n_buckets)]
    for i, t in rows:
        h = h_of(i, t)
        k = xxhash.xxh64(struct.pack("<q", h), seed=int_hash(seed)).intdigest()
        k = signed(xxhash.xxh64(struct.pack("<q", 0), seed=k).intdigest())
        buckets[k % n_buckets].append((h, i, t))
    order = []
    for b, held in enumerate(buckets):
        held.sort(key=lambda r: r[0])
        order += [held[j] for j in sharding.fisher_yates(len(held), seed ^ (b * sharding._GAMMA))]
    n, out = len(order), []
    for s in range(shards):
        lo, hi = s * n // shards, (s + 1) * n // shards
        out += [(i, t, s, p - lo) for p, (_, i, t) in enumerate(order) if lo <= p < hi]
    return out


def int_hash(x):
    """Spark's hash of an int is XXH64's of its four bytes."""
    return xxhash.xxh64(struct.pack("<i", x), seed=42).intdigest()


def key(r):
    return (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2], r[3])


@pytest.mark.parametrize("bucket_bytes", [3000, 1 << 20])
def test_shards_are_the_plain_two_pass_shuffle(spark, bucket_bytes):
    rows = [(i, "é" * (i % 50) if i % 9 else None) for i in range(500)] + [(None, "no id"), (3, "same id"), (777, "long " * 20000)]
    got = sharding.shuffled_shards(frame(spark, rows).repartition(5), 8, bucket_bytes=bucket_bytes)
    assert got.columns == ["doc_id", "text", "size", "at", "shard", "slot"]
    have = sorted(((r.doc_id, r.text, r.shard, r.slot) for r in got.collect()), key=key)
    assert have == sorted(brute(rows, 8, bucket_bytes), key=key)


def test_counts_slots_and_hot_copies(spark):
    rows = [(7, "copy")] * 3000 + [(i, "t") for i in range(6005)]
    got = sharding.shuffled_shards(frame(spark, rows).repartition(4), 8, bucket_bytes=20_000)
    by = {}
    for r in got.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(8)) and sum(map(len, by.values())) == 9005
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    copies = [r.n for r in got.filter("text = 'copy'").groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(copies) == 8 and max(copies) < 1000      # the hot record is spread over buckets and shards


def test_order_is_shuffled():
    order = sharding.fisher_yates(1000, 5)
    assert sorted(order) == list(range(1000)) and order != list(range(1000))
    assert sum(abs(a - b) for a, b in enumerate(order)) / 1000 > 250
    first = [sharding.fisher_yates(4, s)[0] for s in range(4000)]
    assert all(abs(first.count(k) - 1000) < 150 for k in range(4))
    assert sharding.fisher_yates(0, 1) == [] and sharding.fisher_yates(1, 1) == [0]


def test_layout_does_not_matter_and_files_ascend(spark, scratch):
    rows = [(i, f"text {i}") for i in range(200)]
    a = sharding.shuffled_shards(frame(spark, rows).repartition(3), 4)
    b = sharding.shuffled_shards(frame(spark, rows[::-1]).repartition(6), 4)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    sharding.write_shards(a, f"{scratch}/out")
    back = spark.read.parquet(f"{scratch}/out").withColumn("file", F.input_file_name()).collect()
    assert len(back) == 200
    last = {}
    for r in back:
        assert last.get(r.file, -1) < r.slot
        last[r.file] = r.slot


def test_empty_and_clashing(spark):
    assert sharding.shuffled_shards(frame(spark, [])).collect() == []
    assert [(r.shard, r.slot) for r in sharding.shuffled_shards(frame(spark, [(None, None)])).collect()] == [(7, 0)]
    odd = frame(spark, [(1, "a"), (2, "b")]).withColumn("slot", F.lit("x")).withColumn("__docflow_h", F.lit(9)).withColumn("c0", F.lit(7))
    got = sharding.shuffled_shards(odd, 2)
    assert got.columns == [*odd.columns, "shard", "slot_"]
    assert sorted((r.doc_id, r.slot, r["__docflow_h"], r.c0, r.slot_) for r in got.collect()) == [(1, "x", 9, 7, 0), (2, "x", 9, 7, 0)]
