"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 64-bit hash of its id and text.  A source with target T
and size S takes all its documents ``T // S`` times, and those below a hash
threshold once more.  The threshold is found without sorting: words are
summed by source and hash bucket, the bucket in which the running sum passes
the budget is located, and only that bucket is cut into finer ones, until it
holds one hash value.  A source whose budget falls inside a document takes or
leaves that document, whichever comes nearer to the target.  Thresholds are
nested: a larger budget takes a superset.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating,
and share ``share`` times all words; a target above ``max_repeats`` times its
source's size stops there and the excess is shared again by weight, until
none is above.

Only DataFrame functions run; what reaches the driver are a few sums per
round.  Defined cases: a null text has no words; rows that repeat id and text
have one hash and go together; sources without words have target 0; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import WORD, by_place, materialize, own_names, text_of
from docflow.operators.ranking import ranked

BITS = 12            # hash bits a level: 4,096 buckets a source


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, h (hash of id and text), size (words): one narrow row per document."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(F.col(id_col), text).alias("h"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def targets(totals: DataFrame, weights=(1.0, 2.0, 3.0), share: float = 1.0, max_repeats: float = 3.0) -> DataFrame:
    """(source, source_size) -> with ``target``."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = materialize(ranked(totals, [F.col("source").asc_nulls_last()]).withColumn("weight", w)
                    .withColumn("most", F.col("source_size") * F.lit(float(max_repeats))), "mix-sources")
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= F.col("most")
        n, used, open_w, total = t.agg(F.count_if(full), F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                       F.sum(F.when(~full, F.col("weight")).otherwise(0.0)), F.sum("source_size")).first()
        if n == capped or not open_w:
            break
        capped, level = n, (share * total - used) / open_w
    fair = F.col("most") if level is None or not open_w else F.least(F.col("most"), F.col("weight") * F.lit(level))
    return t.select("source", "source_size", fair.alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame, bits: int = BITS) -> DataFrame:
    """(source, budget) -> (source, below, upto): documents with hash value
    (as unsigned) under ``below`` are taken, and the one value ``upto``
    (null: none) too.  ``docs`` has source, key (63-bit non-negative) and size."""
    open_ = budgets.select("source", F.col("budget").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    done = None
    shift = 63
    while shift > 0:
        step = min(bits, shift)
        shift -= step
        live = docs.join(open_.withColumnRenamed("source", "s"),
                         F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("key", shift + step) == F.col("prefix")))
        hist = live.groupBy("source", F.shiftright("key", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.first("rest").alias("rest"))
        run = F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
        cut = (hist.withColumn("before", F.coalesce(run, F.lit(0)))
               .filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))))
        cut = materialize(cut.select("source", "bucket", "words", "lo", "hi", (F.col("rest") - F.col("before")).alias("rest")), "mix-cut")
        one = cut.filter("lo = hi").select("source", F.col("lo").alias("below"),
                                           F.when(F.col("rest") * 2 > F.col("words"), F.col("lo")).alias("upto"))
        done = one if done is None else done.unionByName(one)
        open_ = cut.filter("lo < hi").select("source", "rest", F.col("bucket").alias("prefix"))
        if open_.isEmpty():
            break
    return done


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1.0, 2.0, 3.0), share: float = 1.0, max_repeats: float = 3.0, bits: int = BITS) -> DataFrame:
    """One row per document: id, source, h, size, source_size, target,
    copies, taken."""
    table = materialize(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(table, weights, share, max_repeats, bits)
    return apply_plan(table, plan)


def plan_mix(table: DataFrame, weights=(1.0, 2.0, 3.0), share: float = 1.0, max_repeats: float = 3.0, bits: int = BITS) -> DataFrame:
    """The mix as one row per source: source_size, target, whole (copies of
    every document), below and upto (hash limits of one more copy)."""
    t = targets(table.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = materialize(t.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    limits = thresholds(table.select("source", F.shiftrightunsigned("h", 1).alias("key"), "size"), plan.select("source", "budget"), bits)
    limits = limits.withColumnRenamed("source", "s")
    return materialize(plan.join(limits, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-limits")


def apply_plan(table: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.withColumnRenamed("source", "plan_source")
    key = F.shiftrightunsigned("h", 1)
    more = F.coalesce((key < F.col("below")) | F.coalesce(key == F.col("upto"), F.lit(False)), F.lit(False))
    copies = F.col("whole") + more.cast("int")
    return (table.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left")
            .select("id", "source", "h", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """The documents the mix takes, with their columns and mix_size,
    mix_source_size, mix_target, mix_copies, mix_taken.  Texts stay where they
    are: the limits are one row per source.  Where an input column has one of
    these names, it stays, and the mix's gets underscores at its end."""
    given = docs
    docs, (id_col, text_col, source_col) = by_place(docs, id_col, text_col, source_col)
    plan = plan_mix(materialize(sizes(docs, id_col, text_col, source_col), "mix-sizes"), **params)
    plan = plan.select(F.lit(True).alias("__docflow_any"), *[F.col(c).alias(f"__docflow_{c}") for c in plan.columns])
    text = text_of(text_col)
    marked = (docs.withColumn("mix_size", F.regexp_count(text, F.lit(WORD)).cast("long"))
              .withColumn("__docflow_key", F.shiftrightunsigned(F.xxhash64(F.col(id_col), text), 1)))
    joined = marked.join(plan, F.col(source_col).cast("string").eqNullSafe(F.col("__docflow_source")))
    key, below, upto = F.col("__docflow_key"), F.col("__docflow_below"), F.col("__docflow_upto")
    more = F.coalesce((key < below) | F.coalesce(key == upto, F.lit(False)), F.lit(False))
    out = (joined.withColumn("mix_source_size", F.col("__docflow_source_size")).withColumn("mix_target", F.col("__docflow_target"))
           .withColumn("mix_copies", (F.col("__docflow_whole") + more.cast("int")).cast("long")).filter("mix_copies > 0")
           .withColumn("mix_taken", F.col("mix_copies") * F.col("mix_size")))
    return own_names(out, given, "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken")
