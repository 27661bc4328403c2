"""Connected components of an edge table, by alternating stars.

Each round replaces the neighbours of a node by links to the smallest one
(first for larger, then for smaller neighbours), which halves the distance to
the component's smallest node.  A round is two aggregations and two joins on
narrow rows; its edges are written to the shared folder, and only a count and
a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, root) for every node of an edge; root
    is the smallest node of its component."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = materialize(e, "cc")
    before, now = None, _state(e)
    while now != before and now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "cc")
        before, now = now, _state(e)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
