"""Near-duplicates by SimHash and multi-index hashing.

Fingerprints are computed where the text lies (Arrow batches, NumPy); from
then on only 64-bit values move, each distinct value once.

Links are pairs at most ``max_bits`` apart.  A fingerprint is cut into
segments; two linked fingerprints differ by at most ``max_bits // segments``
bits in some segment.  With two segments and four bits that is two bits in a
32-bit half, and two halves are that close exactly when the Hamming balls of
radius one around them meet.  So each distinct half value enumerates its ball
of 33 values into a table, members of a shared value are candidates, and the
complete distance decides.

A table value with more than ``dense`` members is not compared pairwise.  Its
members enumerate the ball of radius two (2,081 values) around the complete
fingerprint: two fingerprints are within four bits exactly when these balls
meet, so the shared centre proves the link, a centre has at most 2,081
members, and the work grows with the members, not with their square.

Components are found by alternating stars over the distinct fingerprints.

Defined cases: a null text is empty; a text without words has fingerprint
zero and links like any other; equal fingerprints are one node; a null id is
ignored as the smallest id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import keep_rows, materialize, text_of
from docflow.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
DENSE = 128          # members of a table value that are compared pairwise at most
ROWS = 8192          # shingle hashes unpacked at a time


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text as an unsigned 64-bit number."""
    from itertools import repeat

    from xxhash import xxh64_intdigest
    words = text.lower().split()   # bytes: only A-Z change, and the separators are blank and \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        grams, n = [b" ".join(words)], 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, ROWS):
        part = h[i:i + ROWS]
        pad = -len(part) % 255          # 255 one-bit rows fit a byte sum
        bits = np.unpackbits(np.concatenate([part, np.zeros(pad, np.uint64)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id, text_hash (xxhash64 of the text) and fp (the fingerprint's bits as
    a long), one row per document."""
    def run(batches):
        for b in batches:
            fps = np.array([simhash(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in b.column("t").cast(pa.binary())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), pa.array(fps.view(np.int64))], names=["id", "text_hash", "fp"])
    text = text_of(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    return src.mapInArrow(run, "id long, text_hash long, fp long")


def ball(bits: int, radius: int) -> list[int]:
    """XOR masks of all values at most ``radius`` bits away, as signed longs."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def around(df: DataFrame, value: str, bits: int, radius: int, out: str) -> DataFrame:
    masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, radius)])
    return df.withColumn("__mask", F.explode(masks)).withColumn(out, F.col(value).bitwiseXOR(F.col("__mask"))).drop("__mask")


def segments(fps: DataFrame, bits: int = 32) -> DataFrame:
    """fp and each segment's value, tagged with the segment's number above
    its bits."""
    parts = [F.shiftrightunsigned("fp", i * bits).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(i << bits) for i in range(64 // bits)]
    return fps.select("fp", F.explode(F.array(*parts)).alias("part"))


def pair_links(buckets: DataFrame, max_bits: int) -> DataFrame:
    """Links inside small buckets (an array of fingerprints each): per bucket
    the verified pairs, reduced to a star per connected part."""
    def run(batches):
        for b in batches:
            us, vs = [], []
            col = b.column("fps")
            flat, off = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            off = off - off[0]
            for s, e in zip(off[:-1], off[1:]):
                x = np.sort(flat[s:e])
                near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= max_bits
                root = np.arange(len(x))
                while True:                  # smallest index reachable, by repeated minimum over neighbours
                    new = np.where(near, root[None, :], len(x)).min(axis=1)
                    if (new == root).all():
                        break
                    root = new
                moved = np.flatnonzero(root != np.arange(len(x)))
                us.append(x[moved])
                vs.append(x[root[moved]])
            cat = lambda a: pa.array(np.concatenate(a) if a else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([cat(us), cat(vs)], names=["u", "v"])
    return buckets.select("fps").mapInArrow(run, "u long, v long").distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints at most ``max_bits``
    (0 to 4) apart, directly or through others that close."""
    if not 0 <= max_bits <= 4:
        raise ValueError("two segments with radius two serve 0 to 4 bits")
    halves = segments(fps)
    sizes = halves.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    shared = around(sizes, "part", 32, 1, "key").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    # the balls hold 66 times the rows that Spark's estimate has, so neither side may be broadcast by it
    members = materialize(around(halves, "part", 32, 1, "key").select("fp", "key").join(shared.hint("merge"), "key"), "simhash-members")
    small = members.filter(F.col("n") <= dense).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    out = pair_links(small, max_bits)
    hot = members.filter(F.col("n") > dense).select("fp").distinct()
    centres = around(hot, "fp", 64, max_bits // 2, "centre").groupBy("centre").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    if max_bits % 2:     # balls of radius r meet up to 2r bits apart; an odd limit still verifies the pair
        return out.unionByName(pair_links(around(hot, "fp", 64, max_bits // 2 + 1, "centre").groupBy("centre").agg(F.collect_list("fp").alias("fps")), max_bits))
    star = centres.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).filter("u <> v").select("u", "v").distinct()
    return out.unionByName(star)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """One row per document: id, text_hash, fp, root (smallest fingerprint of
    the component), component_id (smallest id of the documents reachable
    through links)."""
    table = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    nodes = materialize(table.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    comps = materialize(connected_components(links(nodes.select("fp"), max_bits, dense)), "simhash-comps")
    rooted = nodes.join(comps.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return table.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each component, the one with the
    smallest id (of rows that share it, the smallest text hash); rows that
    repeat id and text are one document and stay or go together."""
    near = materialize(near_duplicates(docs, id_col, text_col, **params), "simhash-groups")
    own = F.col("id").eqNullSafe(F.col("component_id"))
    # written first, so that the join on a large component's root can be split
    first = materialize(near.filter(own).groupBy("root").agg(F.min("text_hash").alias("keep_hash")), "simhash-first")
    losers = near.join(first, "root").filter(~(own & (F.col("text_hash") == F.col("keep_hash"))))
    return keep_rows(docs, {"id": F.col(id_col).cast("long"), "text_hash": F.xxhash64(text_of(text_col))}, losers)
