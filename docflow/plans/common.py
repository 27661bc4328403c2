"""Helpers shared by the plan modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflow.session import configure, table_path


# Tables whose rows carry heavy per-row work (HTML, long texts).
HEAVY = {"pages", "documents", "conversations"}


def read(spark: SparkSession, sf_dir: str, name: str, heavy: bool | None = None) -> DataFrame:
    """A driver table.  The session setting ``spark.docflow.spread`` (a number
    of partitions, unset by default) deals out the rows of ``heavy`` tables
    (default: by table): single-file tables have one split, so a bench on one
    machine sets it to use its cores.  A cluster leaves it unset."""
    configure(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    parts = spark.conf.get("spark.docflow.spread", None)
    return df.repartition(int(parts)) if parts and (name in HEAVY if heavy is None else heavy) else df
