"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import configure, scratch_path, table_path

#: Words of a text: runs of anything but blank and the five ASCII controls.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``.  Rows are whole texts, so Arrow batches are
    bounded by bytes as well as by rows."""
    prepare(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def materialize(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and
    read it back: the lineage is cut, a lost executor costs no recomputation,
    and later readers prune columns.  A table whose rows are megabytes names
    the bytes of a ``row_group``: writers and readers hold one at a time, and
    Parquet else looks at its size every hundred rows only."""
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    sizes = {"parquet.block.size": row_group, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1} if row_group else {}
    df.write.options(**sizes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: Column | str, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n`` (a null id counts as the
    empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def by_place(docs: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by their place, so that no name clashes
    with a helper's, and the new names of the columns ``named``."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [f"c{docs.columns.index(c)}" for c in named]


def own_names(out: DataFrame, docs: DataFrame, *results: str) -> DataFrame:
    """Undoes ``by_place``: the columns of ``docs`` under their names, then the
    ``results``, with underscores at the end of a name that ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    def unused(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        return name
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], *[F.col(r).alias(unused(r)) for r in results])


def keep_rows(docs: DataFrame, keys: dict[str, Column], drop: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` (name -> expression) are not in
    ``drop`` (a table with those names), null-safe, with the columns of
    ``docs`` only.  The smaller side ``drop`` is hashed, so texts are never
    sorted, and adaptive execution splits a skewed side."""
    marked = docs
    names = {k: f"__docflow_{k}" for k in keys}
    for k, c in keys.items():
        marked = marked.withColumn(names[k], c)
    right = drop.select(*[F.col(k).alias(f"{n}_r") for k, n in names.items()]).distinct()
    cond = None
    for n in names.values():
        c = F.col(n).eqNullSafe(F.col(f"{n}_r"))
        cond = c if cond is None else cond & c
    return marked.join(right.hint("shuffle_hash"), cond, "left_anti").drop(*names.values())


def sample_ids(rows: DataFrame, id_col: str, limit: int, by: str | None = None) -> DataFrame:
    """At most ``limit`` rows (for each value of ``by``, if given), those with
    the lowest hash of the id: a documented bound for fitting a classifier.
    Rows are counted first, and each task keeps only those whose hash is in
    the share that twice the limit needs, so what is ranked does not grow with
    the table."""
    from pyspark.sql import Window as W
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    share_of = F.shiftrightunsigned(F.xxhash64(F.col(id_col)).bitwiseXOR(F.lit(-(1 << 63))), 11) / float(1 << 53)
    enough = share_of * F.col("__n") <= 2 * limit + 100
    if by is None:
        return rows.withColumn("__n", F.lit(rows.count())).filter(enough).drop("__n").orderBy(*order).limit(limit)
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    low = rows.join(counts, by).filter(enough).drop("__n")
    rank = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return low.withColumn("__rank", rank).filter(F.col("__rank") <= limit).drop("__rank")


def share(spark: SparkSession, model):
    """Broadcast a fitted model (of bounded size) as bytes that carry its
    class by value; tasks read it with ``opened``."""
    from pyspark import cloudpickle
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def opened(held):
    import pickle
    return pickle.loads(held.value)
