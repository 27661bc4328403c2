"""The pipeline and the registered queries."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docflow.llm import decontam, mixing, queries, simhash
from docflow.llm.common import read
from docflow.plans.oracle import duck, rows, type_diff
from tests.conftest import SF_CHECK, SF_SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Planted cases in a small corpus."""
    d = str(tmp_path_factory.mktemp("corpus"))
    r = random.Random(1)
    vocab = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.choice([1, 2, 3]))) for _ in range(900)]
    text = lambda n=80: " ".join(r.choice(vocab) for _ in range(n))
    docs = [(i, text(), "en", f"s{i % 3}") for i in range(300)]
    labels = []
    for i in range(300, 400):                     # toxic documents
        words = text().split()
        for _ in range(3):
            words[r.randrange(80)] = r.choice(["idiot", "moron", "scum"])
        docs.append((i, " ".join(words), "en", "s0"))
    labels = [(i, 1, int(i >= 300)) for i in range(400) if i % 10]
    docs += [(400 + i, docs[5][1], "en", "s1") for i in range(40)]                                   # exact copies
    docs += [(450 + i, docs[6][1] + "  " * (i + 1), "en", "s1") for i in range(5)]                   # near copies
    item = text(30)
    docs += [(460 + i, text(20) + " " + item + " " + text(20), "en", "s2") for i in range(3)]        # benchmark passages
    docs += [(470, None, None, None), (471, "", "en", None), (472, text(5000), "de", "s2"), (5, docs[5][1], "en", "s1")]
    spark.createDataFrame([(*x, len(x[1] or "")) for x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, text(12)), (3, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_on_planted_cases(spark, tables):
    docs, kept = read(spark, tables, "documents"), {}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, tables)
        if k < 4:
            assert out.columns == COLUMNS
        out.write.parquet(path := f"{tables}/out{k}")
        docs = spark.read.parquet(path)
        kept[name] = sorted((x.doc_id for x in docs.select("doc_id").collect()))
    clean = set(range(300)) - {5, 6}
    toxic = set(range(300, 400))
    assert not toxic & set(kept["toxicity"]) and clean <= set(kept["toxicity"])
    exact = set(kept["exact dedup"])
    assert len(kept["exact dedup"]) == len(exact) and 439 in exact and 5 not in exact and not set(range(400, 439)) & exact and clean <= exact
    assert 471 in exact and 470 not in exact                            # null equals empty, the larger id stays
    near = set(kept["simhash near-dedup"])
    assert 6 in near and not set(range(450, 455)) & near and clean <= near
    free = set(kept["decontamination"])
    assert not {460, 461, 462} & free and near - {460, 461, 462} == free
    mixed = docs.collect()
    by = {}
    for x in mixed:
        assert x.mix_copies >= 1 and x.mix_taken == x.mix_copies * x.mix_size <= 3 * x.mix_size
        by.setdefault(x.source, [0, x.mix_target, 0])
        by[x.source][0] += x.mix_taken
        by[x.source][2] = max(by[x.source][2], x.mix_size)
    assert all(abs(got - want) <= most for got, want, most in by.values())


def test_run_equals_the_stages(spark, tables):
    want = sorted((x.doc_id, x.mix_copies) for x in spark.read.parquet(f"{tables}/out4").collect())
    assert sorted((x.doc_id, x.mix_copies) for x in corpus_pipeline.run(spark, tables).collect()) == want


def test_stages_on_an_empty_table(spark, tables):
    docs = read(spark, tables, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.count() == 0
        docs = docs.select(*COLUMNS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    df, rel = queries.QUERIES[name](spark, SF_CHECK), duck(SF_CHECK).sql(queries.SQL[name])
    assert type_diff(df, rel) == {} and rows(df.toPandas()) == rows(rel.df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_covers_its_table(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    table, key = ("pages", "page_id") if name == "op6_url_filter" else ("documents", "doc_id")
    got = sorted(x[0] for x in df.select(key).collect())
    assert got == sorted(x[0] for x in duckdb.sql(f"SELECT {key} FROM '{SF_SMALL}/{table}.parquet'").fetchall())


def test_no_udf_in_the_native_plan(spark):
    from docflow.llm import exact_dedup
    docs = read(spark, SF_SMALL, "documents")
    for df in (exact_dedup.exact_dedup(docs), exact_dedup.drop_exact_duplicates(docs), exact_dedup.signatures(docs, F.col("text"))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_texts_are_not_shuffled_by_the_searches(spark):
    docs = read(spark, SF_SMALL, "documents")
    assert "Exchange" not in decontam.build_index(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in simhash.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in mixing.sizes(docs)._jdf.queryExecution().executedPlan().toString()


def test_decontamination_holds_few_blocks_at_once(spark, tmp_path):
    """Stage 4 over a task of many blocks: no row group of the index has them all."""
    from pathlib import Path

    from docflow.session import scratch_path
    from tests.llm.test_decontam import row_groups
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(50_000)]
    item = " ".join(r.choices(vocab, k=12))
    texts = [" ".join(r.choices(vocab, k=20_000)) + (f" {item}" if i % 50 == 7 else "") for i in range(300)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = Path(scratch_path(spark, "llm").removeprefix("file://").removeprefix("file:"))
    seen = set(folder.glob("decontam-index-*"))
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert sorted(x.doc_id for x in kept.select("doc_id").collect()) == [i for i in range(300) if i % 50 != 7]
    groups = row_groups(str(p) for d in set(folder.glob("decontam-index-*")) - seen for p in d.glob("*.parquet"))
    assert sum(g.num_rows for g in groups) > 6 and 3 * max(g.total_byte_size for g in groups) < sum(g.total_byte_size for g in groups)
