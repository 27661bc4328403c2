"""Every registered query of the operators, and the pipeline, returns on empty tables."""

import pytest

import corpus_pipeline
from docflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["documents", "pages", "benchmark", "labels", "conversations", "embeddings"]


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query_returns(spark, empty_dir, name):
    rows = {**QUERIES, "pipeline": corpus_pipeline.run}[name](spark, empty_dir).collect()
    assert [r.conv_id for r in rows] == ([-7] if name == "op9_chat" else [])
