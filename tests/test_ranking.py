"""Row numbers of sorted ranges, and a package that needs no ``llm`` folder."""

import os
import re

from pyspark.sql import functions as F

from docflow.operators.ranking import ranked

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_ranks_are_the_sorted_positions(spark):
    rows = [(i * 7919 % 1000, None if i % 10 == 0 else f"k{i % 3}") for i in range(1000)]
    df = spark.createDataFrame(rows, "i long, k string").repartition(7)
    got = ranked(df, [F.col("k").asc_nulls_first(), F.col("i").desc()], "place").collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", -r[0]))
    assert [(r.i, r.k) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1000))


def test_empty_table(spark):
    assert ranked(spark.createDataFrame([], "i long"), [F.col("i")]).collect() == []


def test_nothing_outside_llm_imports_it():
    for top, _, names in os.walk(os.path.join(ROOT, "docflow")):
        for n in names:
            if n.endswith(".py") and os.sep + "llm" not in top:
                assert not re.search(r"(from|import) docflow\.llm", open(os.path.join(top, n)).read()), n
