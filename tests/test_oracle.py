"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate)."""

import pytest

import __spark_entry__ as E
from docflow.plans.oracle import compare, duck
from tests.conftest import SF_CHECK, SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], SF_CHECK, con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_every_query_of_this_package_has_an_oracle():
    from docflow.plans import registry
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["src_lang", "status", "n"]
    assert sum(r["n"] for r in rows) == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
