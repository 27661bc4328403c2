"""Exact duplicates by progressive refinement.

Rows are grouped by byte length, then by a hash of a short prefix, then by
the SHA-256 of the whole text.  Every level passes on only the rows whose
group still has two members, so a text that is alone in its length never
reaches the wider comparisons.  All levels work on a signature table written
once (id, length, prefix hash, digest: about 60 bytes a row); texts are never
shuffled.  A columnar file has to decode a text to know its length, so the
digest is taken in that same read, and later levels compare it only for
surviving groups.

Only DataFrame functions run.  Group sizes and winners are partial
aggregates; a group that holds a third of all rows is decided by a join that
adaptive execution splits.

Defined cases: a null text equals the empty text; of equal texts the largest
id stays, a null id loses to any other, and of rows that repeat both text and
id exactly one stays; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import by_place, materialize, own_names, text_of

PREFIX_CHARS = 256


def signatures(docs: DataFrame, text: Column, id_col: str = "doc_id", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One narrow row per document: id, row_no, n_bytes, prefix_hash, digest."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row_no"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix_hash"),
        F.unhex(F.sha2(text, 256)).alias("digest"))


def shared(sig: DataFrame, *keys: str) -> DataFrame:
    """Rows whose ``keys`` occur at least twice.  The repeated keys are written
    first: a join that reads them through an exchange of their own can be
    split where a key is hot, one on top of an aggregation cannot."""
    twice = sig.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    return sig.join(materialize(twice, "exact-repeated"), list(keys), "left_semi")


def duplicate_groups(sig: DataFrame) -> DataFrame:
    """Groups of two or more equal texts: digest, group_size, keep_id and
    keep_row (the row_no of the row that stays)."""
    left = shared(shared(sig, "n_bytes"), "n_bytes", "prefix_hash")
    rank = F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63)))
    return (left.groupBy("n_bytes", "digest")
            .agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"),
                 F.max_by("row_no", rank).alias("keep_row"))
            .filter("group_size > 1").drop("n_bytes"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per document: the id, keep_id, group_size, kept, text_sha256."""
    sig = materialize(signatures(docs, text_of(text_col), id_col, prefix_chars), "exact-sig")
    found = duplicate_groups(sig)
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    return sig.join(found, "digest", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        size.alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose their group, columns unchanged.

    The table is joined once with the duplicate groups on the digest; a row
    stays if it has no group or carries its group's winning id.  Rows that
    repeat id and text go through a distinct on the digest instead (few
    rows: only those of groups in which the winner's id occurs twice).
    """
    given = docs
    docs, (id_col, text_col) = by_place(docs, id_col, text_col)
    text = text_of(text_col)
    sig = materialize(signatures(docs, text, id_col), "exact-sig")
    groups = duplicate_groups(sig)
    top = (sig.join(groups, "digest")
           .filter(F.col("id").eqNullSafe(F.col("keep_id")))
           .groupBy("digest").agg(F.count(F.lit(1)).alias("__docflow_top"), F.first("keep_id").alias("__docflow_keep"))
           .withColumnRenamed("digest", "__docflow_digest"))
    top = materialize(top, "exact-winners")
    marked = docs.withColumn("__docflow_key", F.unhex(F.sha2(text, 256)))
    joined = marked.join(top.hint("shuffle_hash"), F.col("__docflow_key") == F.col("__docflow_digest"), "left")
    wins = F.col(id_col).eqNullSafe(F.col("__docflow_keep"))
    helpers = [c for c in joined.columns if c.startswith("__docflow_")]
    single = joined.filter(F.col("__docflow_top").isNull() | ((F.col("__docflow_top") == 1) & wins)).drop(*helpers)
    if top.filter("__docflow_top > 1").isEmpty():
        return own_names(single, given)
    # the same join, so both branches read one exchange of the texts
    many = joined.filter((F.col("__docflow_top") > 1) & wins).dropDuplicates(["__docflow_key"]).drop(*helpers)
    return own_names(single.unionByName(many), given)
