"""One commit for several tables, and a newest-version table kept up by batches.

A version of any number of tables is written to folders of its own,
``<root>/<table>/version=N``, and becomes visible by one small file in
``<root>/log/version=N``, written last.  Readers take only what the log names,
so a job that dies between two writes leaves them unchanged; it is repeated
under the same number and replaces what it had written.

The newest-version table (K6) holds its ids in hash buckets.  A batch reads and
rewrites only the buckets that it touches, as ``version=N/bucket=B`` folders;
a reader takes each bucket from its last committed version.  Nothing grows
with the number of versions an id has had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.latest import latest_version
from docflow.sinks.tables import read_if_exists

LOG = "version long, table string, bucket int"
BUCKETS = 256


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The log: (version, table, bucket); bucket is -1 for a whole table."""
    log = read_if_exists(spark, f"{root}/log")
    if log is None:
        return spark.createDataFrame([], LOG)
    return log.select(F.col("version").cast("long").alias("version"), "table", "bucket")


def commit(spark: SparkSession, root: str, version: int, rows: list[tuple[str, int]]) -> None:
    """Makes the version visible: one file, moved into place when it is whole."""
    (spark.createDataFrame(rows, "table string, bucket int").coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/log/version={int(version)}"))


def next_version(spark: SparkSession, root: str) -> int:
    last = committed(spark, root).agg(F.max("version")).first()[0]
    return 0 if last is None else last + 1


def is_committed(spark: SparkSession, root: str, version: int) -> bool:
    return not committed(spark, root).filter(F.col("version") == int(version)).isEmpty()


def write_version(root: str, version: int, tables: dict[str, DataFrame]) -> bool:
    """Writes all ``tables`` as one version; False if it was committed before
    (then nothing is written)."""
    spark = next(iter(tables.values())).sparkSession
    if is_committed(spark, root, version):
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/version={int(version)}")
    commit(spark, root, version, [(name, -1) for name in tables])
    return True


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The rows of all committed versions of a table, with ``version``; None
    before the first.  Folders of other versions are not read."""
    versions = [r.version for r in committed(spark, root).filter(F.col("table") == table).select("version").distinct().collect()]
    if not versions:
        return None
    return spark.read.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{table}/version={v}" for v in sorted(versions)])


def bucket_versions(spark: SparkSession, root: str) -> dict[int, int]:
    """The last committed version of each bucket (one entry a bucket)."""
    rows = committed(spark, root).filter("table = 'newest'").groupBy("bucket").agg(F.max("version").alias("v")).collect()
    return {r.bucket: r.v for r in rows}


def read_buckets(spark: SparkSession, root: str, buckets: dict[int, int]) -> DataFrame | None:
    if not buckets:
        return None
    paths = [f"{root}/newest/version={v}/bucket={b}" for b, v in sorted(buckets.items())]
    return spark.read.option("basePath", f"{root}/newest").parquet(*paths).drop("version")


def merge_newest(batch: DataFrame, root: str, version: int, key: str, ts: str, arrival: str, buckets: int = BUCKETS) -> list[int]:
    """K6, kept up: of the ids in ``batch`` the table then holds the version
    with the greatest ``ts`` of those it held and those of the batch (among
    equal ones the earliest ``arrival``).  Returns the buckets rewritten; a
    committed version is left as it is."""
    spark = batch.sparkSession
    if is_committed(spark, root, version):
        return []
    kept = bucket_versions(spark, root)
    placed = batch.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(int(buckets)).cast("long")).cast("int"))
    placed = placed.persist()
    try:
        touched = sorted(r.bucket for r in placed.select("bucket").distinct().collect())
        if max([*kept, *touched], default=0) >= buckets:
            raise ValueError(f"the table has more than {buckets} buckets")
        held = read_buckets(spark, root, {b: kept[b] for b in touched if b in kept})
        both = placed if held is None else held.unionByName(placed)
        newest = latest_version(both, key, ts, arrival).dropDuplicates([key])
        (newest.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{root}/newest/version={int(version)}"))
    finally:
        placed.unpersist()
    commit(spark, root, version, [("newest", b) for b in touched] or [("none", -1)])
    return touched


def read_newest(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version of every id; None before the first commit."""
    held = read_buckets(spark, root, bucket_versions(spark, root))
    return None if held is None else held.drop("bucket")
