"""Scoring (U2-U4): topic class, quality, title sentiment, enrich chain.

The original ran fixed neural models on one GPU in batches of 32.  Here a
scorer is one of
- a one-pass model, whose statistics come from one aggregation over all rows
  (class centroids, counts of binned features, word means): the registered
  queries use these, and SQL restates them;
- a Spark ML pipeline (fit and applied on executors);
- a caller-supplied pandas function run with ``mapInPandas`` in Arrow batches
  (``spark.sql.execution.arrow.maxRecordsPerBatch`` plays the batch size).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import clean_title


def text_features(text: str = "text", num_features: int = 1 << 16):
    """Tokenizer + HashingTF + IDF: no vocabulary pass, fixed width."""
    return [RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[\s\p{Punct}]+", toLowercase=True),
            HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
            IDF(inputCol="_tf", outputCol="features")]


def _fit_on_features(data: DataFrame, head, estimator) -> PipelineModel:
    """Tokenize and hash once, persist the hashed vectors for the IDF pass
    and the estimator's iterations, then release them."""
    tok, tf, idf = head
    hashed = tf.transform(tok.transform(data)).select("_tf", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf_model = idf.fit(hashed)
        model = estimator.fit(idf_model.transform(hashed))
    finally:
        hashed.unpersist()
    return PipelineModel(stages=[tok, tf, idf_model, model])


def fit_text_classifier(train: DataFrame, text: str, label: str, max_iter: int = 20) -> PipelineModel:
    """U2 scorer over text (e.g. documents ⋈ labels)."""
    data = train.select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    return _fit_on_features(data, text_features("text"), LogisticRegression(maxIter=max_iter, regParam=0.01))


def fit_vector_classifier(train: DataFrame, vec: str, label: str, max_iter: int = 50) -> PipelineModel:
    """U2 scorer over embedding arrays (multinomial, one output per class)."""
    data = train.select(array_to_vector(F.col(vec)).alias("features"),
                        F.col(label).cast("double").alias("label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[LogisticRegression(maxIter=max_iter, family="multinomial")]).fit(data)
    finally:
        data.unpersist()


def score_vectors(model: PipelineModel, df: DataFrame, vec: str) -> DataFrame:
    out = model.transform(df.withColumn("features", array_to_vector(F.col(vec))))
    return out.withColumn("class_probs", vector_to_array("probability")).drop("features", "rawPrediction", "probability")


def score_text(model: PipelineModel, df: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
    """Probability of the positive class, per row."""
    res = model.transform(df.withColumnRenamed(text, "text") if text != "text" else df)
    res = res.withColumn(out, vector_to_array("probability")[1])
    res = res.drop("_tok", "_tf", "features", "rawPrediction", "probability", "prediction")
    return res.withColumnRenamed("text", text) if text != "text" else res


def fit_title_regressor(train: DataFrame, title: str, target: str, max_iter: int = 20) -> PipelineModel:
    """U3 scorer: a linear model over hashed title tokens."""
    data = train.select(clean_title(F.col(title)).alias("text"), F.col(target).cast("double").alias("label")) \
        .filter(F.col("text").isNotNull())
    return _fit_on_features(data, text_features("text", 1 << 16), LinearRegression(maxIter=max_iter, regParam=0.1))


def title_sentiment(model: PipelineModel, df: DataFrame, title: str, out: str = "sentiment") -> DataFrame:
    """Score of the cleaned title; -1 when there is no title or the
    score fails (the original's failure value)."""
    x = df.withColumn("text", F.coalesce(clean_title(F.col(title)), F.lit("")))
    res = model.transform(x)
    ok = F.col(title).isNotNull() & F.col("prediction").isNotNull() & ~F.isnan("prediction")
    res = res.withColumn(out, F.when(ok, F.col("prediction")).otherwise(F.lit(-1.0)))
    return res.drop("text", "_tok", "_tf", "features", "prediction")


# --- one-pass models --------------------------------------------------------

SCALE = 1_000_000     # embeddings are summed as integers, so the order of rows does not matter


def class_centroids(train: DataFrame, vec: str, label: str) -> list[tuple]:
    """(label, mean vector) of every class, in label order: one aggregation by
    class and dimension."""
    each = train.filter(F.col(label).isNotNull()).select(F.col(label).alias("c"), F.posexplode(vec).alias("i", "x"))
    q = F.round(F.col("x").cast("double") * SCALE).cast("long")
    rows = each.groupBy("c", "i").agg(F.sum(q).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("c", "i").collect()
    out: dict = {}
    for r in rows:
        out.setdefault(r.c, []).append(r.s / r.n)
    return list(out.items())


def nearest_centroid(df: DataFrame, vec: str, centroids: list[tuple]) -> DataFrame:
    """U2 over vectors: ``topic`` (class of the nearest centroid, the first on
    a tie) and ``confidence`` (0.5 to 1: the second distance's share of the two
    smallest).  The centroids travel in the plan: classes x dimensions values.
    Without any class the topic is null."""
    if not centroids:
        return df.withColumn("topic", F.lit(None).cast("int")).withColumn("confidence", F.lit(None).cast("double"))
    x = F.transform(vec, lambda v: F.round(v.cast("double") * SCALE))
    dist = lambda c: F.aggregate(F.zip_with(x, F.lit([float(v) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    ranked = F.array_sort(F.array(*[F.struct(dist(c).alias("d"), F.lit(label).alias("c")) for label, c in centroids]))
    out = df.withColumn("_near", ranked)
    first, second = F.col("_near")[0]["d"], F.try_element_at("_near", F.lit(2))["d"]
    return out.withColumn("topic", F.col("_near")[0]["c"]) \
        .withColumn("confidence", F.coalesce(F.when(first + second > 0, second / (first + second)), F.lit(1.0))).drop("_near")


def text_bins(text: str = "text") -> dict[str, Column]:
    """Small integers that describe a text: length, and shares of capitals,
    marks and blanks (null texts count as empty)."""
    t = F.coalesce(F.col(text), F.lit(""))
    share = lambda pattern, n: F.floor((F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) * n / F.greatest(F.length(t), F.lit(1))).cast("int")
    return {"size": F.least(F.floor(F.length(t) / 500), F.lit(20)).cast("int"), "capitals": share("[A-Z]", 20),
            "marks": share("[#$%&*!|]", 50), "blanks": share(" ", 50)}


class BinModel:
    """Counts of each feature's bins by class (0, 1) and of the classes."""

    def __init__(self, counts: dict[tuple[str, int], tuple[int, int]], totals: tuple[int, int]):
        self.counts, self.totals = counts, totals

    def odds(self, name: str, bins: int) -> dict[int, float]:
        """Log odds of each bin seen, with one added to every count."""
        n0, n1 = self.totals
        return {b: math.log((c1 + 1) / (n1 + bins)) - math.log((c0 + 1) / (n0 + bins)) for (f, b), (c0, c1) in self.counts.items() if f == name}


BINS = 51             # of any feature, for smoothing


def fit_bins(train: DataFrame, label: str, features: dict[str, Column]) -> BinModel:
    """One aggregation over the labelled rows; what it returns is bounded by
    features x bins."""
    lab = train.filter(F.col(label).isNotNull()).select((F.col(label) > 0).cast("int").alias("y"), *[c.alias(f) for f, c in features.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features]))
    rows = lab.select("y", pairs.alias("p")).groupBy("p.f", "p.b").agg(F.count_if(F.col("y") == 0).alias("c0"), F.count_if(F.col("y") == 1).alias("c1")).collect()
    first = next(iter(features))
    totals = (sum(r.c0 for r in rows if r.f == first), sum(r.c1 for r in rows if r.f == first))
    return BinModel({(r.f, r.b): (r.c0, r.c1) for r in rows}, totals)


def score_bins(model: BinModel, features: dict[str, Column]) -> Column:
    """Probability of class 1 (naive Bayes over the bins; an unseen bin says
    nothing)."""
    n0, n1 = model.totals
    z = F.lit(math.log((n1 + 1) / (n0 + 1)))
    for f, c in features.items():
        odds = model.odds(f, BINS)
        if odds:
            z = z + F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(odds.items()) for x in kv]), c), F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def title_words(title: str) -> Column:
    return F.filter(F.split(F.lower(F.col(title)), " "), lambda w: w != "")


def word_means(train: DataFrame, title: str, target: str) -> DataFrame:
    """(word, mean): the mean target of the titles with the word (each
    occurrence counts); one aggregation."""
    each = train.filter(F.col(target).isNotNull()).select(F.explode(title_words(title)).alias("word"), F.col(target).alias("y"))
    return each.groupBy("word").agg((F.sum("y") / F.count(F.lit(1))).alias("mean"))


def mean_sentiment(df: DataFrame, key: str, title: str, means: DataFrame, out: str = "sentiment") -> DataFrame:
    """(key, sentiment): mean of the title's known words, -1 without any."""
    each = df.select(key, F.explode(title_words(title)).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("k"))
    known = each.join(means, "word").groupBy(key).agg((F.sum(F.col("k") * F.col("mean")) / F.sum("k")).alias(out))
    return df.select(key).join(known, key, "left").withColumn(out, F.coalesce(out, F.lit(-1.0)))


ScoreFn = Callable[[pd.DataFrame], pd.DataFrame]


def score_with(df: DataFrame, fn: ScoreFn, schema: str) -> DataFrame:
    """Caller-supplied scorer: ``fn`` gets a pandas batch and returns the
    rows to emit (``schema``).  Filter rows before calling: a filter above
    ``mapInPandas`` is not pushed below it."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b):
                yield fn(b)
    return df.mapInPandas(run, schema)


def enrich(df: DataFrame, steps: list[tuple[str, Callable[[DataFrame], DataFrame], Column]],
           status: str = "status") -> DataFrame:
    """U4: run ``steps`` in order; each is (name, step, check) where
    ``check`` is a Column that must hold after the step.  A row failing any
    check gets status 1 (and keeps going, so the ledger gets every row);
    rows with status 0 are the records to write."""
    ok = F.lit(True)
    for _name, step, check in steps:
        df = step(df)
        ok = ok & F.coalesce(check, F.lit(False))
        df = df.withColumn("_ok", ok)
        ok = F.col("_ok")
    return df.withColumn(status, F.when(F.col("_ok"), 0).otherwise(1)).drop("_ok")
