"""Mixing against a sorted brute force."""

import random
import re

import pytest

from docflow.llm import mixing

DOCS = "doc_id long, text string, source string, size string, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], DOCS)


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        if not open_:
            return fixed
        rest = total - sum(fixed.values())
        got = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if got[s] >= cap * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed |= {s: cap * sizes[s] for s in over}


def corpus(seed, hot=False):
    r = random.Random(seed)
    rows = []
    for i in range(400):
        src = "hot" if hot and i % 3 else r.choice(["a", "B", "é", "z9", None, "tiny"])
        if src == "tiny" and i % 7:
            src = "a"
        rows.append((i, " ".join(["w"] * r.choice([0, 1, 5, 30, 200])), src))
    return rows + [(900, None, "a"), (901, "", None), (5, rows[5][1], rows[5][2]), (902, "only \t\x0b\x0c two", "z9")]


@pytest.mark.parametrize("seed,hot,bits", [(1, False, 12), (2, True, 2), (3, True, 63)])
def test_mix_comes_near_its_targets(spark, seed, hot, bits):
    rows = corpus(seed, hot)
    got = mixing.mix(frame(spark, rows), bits=bits).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_id = {}
    for i, t, _ in rows:
        by_id[i] = size(t)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = brute_targets(sizes)
    taken, largest = {}, {}
    for x in got:
        assert x.size == by_id[x.id] and x.source_size == sizes[x.source]
        assert x.target == pytest.approx(want[x.source])
        assert x.taken == x.copies * x.size and 0 <= x.taken <= 3 * x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
        largest[x.source] = max(largest.get(x.source, 0), x.size)
    for s, t in want.items():
        assert abs(taken.get(s, 0) - t) <= largest[s], s      # repeated rows are one unit: at most the largest document off
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5), bits=bits).collect()
    assert sorted((str(x) for x in again)) == sorted(str(x) for x in got)


def test_limits_are_nested(spark):
    rows = corpus(4)
    small = {(x.id, x.h): x.copies for x in mixing.mix(frame(spark, rows), share=0.3).collect()}
    large = {(x.id, x.h): x.copies for x in mixing.mix(frame(spark, rows), share=0.8).collect()}
    assert all(large[k] >= n for k, n in small.items())


def test_mix_rows_agrees_with_mix(spark):
    docs = frame(spark, corpus(6))
    want = sorted((x.id, x.copies) for x in mixing.mix(docs).collect() if x.copies)
    out = mixing.mix_rows(docs)
    assert out.columns[:5] == docs.columns
    assert sorted((x.doc_id, x.mix_copies) for x in out.collect()) == want


def test_empty_and_wordless(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mix_rows(frame(spark, [])).collect() == []
    got = mixing.mix(frame(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(x.taken, x.target) for x in got] == [(0, 0.0), (0, 0.0)]
    one = mixing.mix(frame(spark, [(1, "a b c", "a")])).collect()[0]
    assert (one.target, one.taken) == (3.0, 3)


def test_rank_across_ranges(spark):
    names = [f"s{i:04d}" for i in range(300)] + [None]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    from pyspark.sql import functions as F
    got = {x.source: x["rank"] for x in mixing.ranked(df, [F.col("source").asc_nulls_last()]).collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_input_columns_of_the_same_names_stay(spark):
    docs = frame(spark, [(1, "a b c", "s"), (2, "d e", "s")]).selectExpr("*", "'own' AS mix_size", "7 AS __docflow_key")
    got = mixing.mix_rows(docs)
    assert got.columns == [*docs.columns, "mix_size_", "mix_source_size", "mix_target", "mix_copies", "mix_taken"]
    assert sorted((x.doc_id, x.mix_size, x["__docflow_key"], x.mix_size_) for x in got.collect()) == [(1, "own", 7, 3), (2, "own", 7, 2)]
