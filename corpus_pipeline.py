"""A training corpus from ``documents``: toxic texts go, then exact and near
duplicates, then benchmark passages, and what is left is mixed by source.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and works on all
its predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontam, exact_dedup, mixing, simhash, toxicity
from docflow.llm.common import crc_mod, keep_rows, materialize, read, text_of

REJECT = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the toxicity grammar scores ``REJECT`` or more."""
    labels = read(spark, sf_dir, "labels").filter(crc_mod("doc_id", 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.filter(F.col("__docflow_score") < REJECT).drop("__docflow_score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage (ten words of an item) go."""
    found = materialize(decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")).filter("n_hit > 0").select("doc_id", "text_hash"), "contaminated")
    return keep_rows(docs, {"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64(text_of("text"))}, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with mix_copies (how often) and mix_taken (words)."""
    return mixing.mix_rows(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("simhash near-dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix_sources)]

#: Fitted scores and 64-bit hashes are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k}-{name.replace(' ', '-')}")
    return docs
