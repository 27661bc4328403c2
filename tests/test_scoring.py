"""Scorer contract."""

import pandas as pd
from pyspark.sql import functions as F

from docflow.operators import scoring as M
from tests.conftest import SF_SMALL


def test_title_sentiment_failure_value(spark):
    train = spark.createDataFrame([("good news", 1.0), ("bad news", 0.0)] * 5, "title string, y double")
    model = M.fit_title_regressor(train, "title", "y")
    df = spark.createDataFrame([(1, "good"), (2, None)], "id long, title string")
    got = {r["id"]: r["sentiment"] for r in M.title_sentiment(model, df, "title").collect()}
    assert got[2] == -1.0 and got[1] != -1.0


def test_enrich_marks_failures(spark):
    df = spark.createDataFrame([(1, "en", "text"), (2, None, "text"), (3, "en", "")], "id long, lang string, text string")
    steps = [("meta", lambda x: x, F.col("lang").isNotNull()),
             ("text", lambda x: x.withColumn("n", F.length("text")), F.col("n") > 0)]
    got = {r["id"]: r["status"] for r in M.enrich(df, steps).collect()}
    assert got == {1: 0, 2: 1, 3: 1}


def test_caller_scorer(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")

    def fn(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": b["doc_id"], "score": b["text"].str.len().astype("float64")})
    out = M.score_with(df, fn, "doc_id long, score double")
    assert out.count() == df.count()


def test_topic_classifier_learns(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    model = M.fit_vector_classifier(emb, "embedding", "label")
    out = M.score_vectors(model, emb, "embedding")
    acc = out.filter(F.col("prediction") == F.col("label")).count() / out.count()
    assert acc > 0.2          # ten classes: well above chance (0.1)
