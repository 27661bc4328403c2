"""Row numbers of a sorted table without a window over all of it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import scratch_path

#: Bits that ``monotonically_increasing_id`` gives to the row within a task.
ROW_BITS = 33


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``."""
    path = scratch_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with ``name`` (from 0) in ``order``.

    Rows are dealt to ranges and sorted in them, and written with their place
    in the range; a range starts after the rows of the ranges before it.  Only
    one row a range (their number is that of the shuffle's partitions) is
    summed up in one task.  ``order`` should be total: rows that tie on it
    share a range and are numbered as they come."""
    place = F.monotonically_increasing_id()
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__place", place))
    part = F.shiftright("__place", ROW_BITS)
    placed = written(placed.withColumn("__part", part).withColumn("__place", F.col("__place") - F.shiftleft(part, ROW_BITS)), "ranges")
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    return (placed.join(F.broadcast(starts), "__part")
            .withColumn(name, F.col("__start") + F.col("__place")).drop("__part", "__place", "__start"))
