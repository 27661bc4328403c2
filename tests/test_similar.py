"""Similarity joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import similar as S


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_overlap_pairs_are_all_pairs(spark, threshold):
    r = random.Random(int(threshold * 10))
    words = ["the"] * 20 + [f"w{i}" for i in range(25)]
    sets = {frozenset(r.choice(words) for _ in range(r.choice([1, 2, 4, 5, 9, 12]))) for _ in range(250)} | {frozenset(), frozenset({"the"})}
    sets = dict(enumerate(sets))
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, tokens array<string>")
    got = {frozenset((x.a, x.b)): round(x.overlap, 9) for x in S.overlap_pairs(df, threshold).collect()}
    want = {}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and len(a & b) >= threshold * min(len(a), len(b)) - 1e-9:
                want[frozenset((i, j))] = round(len(a & b) / min(len(a), len(b)), 9)
    assert got == want and len(want) > 50


def test_a_common_token_makes_no_square(spark):
    """Every set holds one token; only what the rarest tokens lead to is read."""
    n = 600
    df = spark.range(n).select("id", F.array(F.lit("the"), F.lit("of"), *[F.concat(F.lit(c), (F.col("id") / k).cast("int").cast("string")) for c, k in (("a", 1), ("b", 2), ("c", 3), ("d", 5))]).alias("tokens"))
    seen = []
    real = S.written
    try:
        S.written = lambda d, name: seen.append((name, real(d, name))) or seen[-1][1]
        S.overlap_pairs(df, 0.8).count()
    finally:
        S.written = real
    assert dict(seen)["candidates"].count() < 3 * n


@pytest.mark.parametrize("k", [1, 2, 5])
def test_edit_pairs_are_all_pairs_of_a_block(spark, k):
    r = random.Random(k)
    base = ["".join(r.choice("abé𝄞") for _ in range(r.choice([0, 1, 2, 5, 9, 14, 30]))) for _ in range(40)]

    def changed(s):
        s = list(s)
        for _ in range(r.randint(0, k + 1)):
            at = r.randint(0, len(s))
            kind = r.choice("idr")
            if kind == "i":
                s.insert(at, r.choice("abé"))
            elif s and at < len(s):
                s[at:at + 1] = [] if kind == "d" else [r.choice("abé")]
        return "".join(s)
    rows = {(r.choice(["h", "i", None]), changed(r.choice(base))) for _ in range(260)}
    rows = [(i, b, s) for i, (b, s) in enumerate(sorted(rows, key=str))]
    df = spark.createDataFrame([*rows, (999, "h", None)], "id long, block string, s string")
    got = {frozenset((x.a, x.b)): x.distance for x in S.edit_pairs(df, k).collect()}
    want = {frozenset((i, j)): d for i, b, s in rows for j, c, t in rows if i < j and b == c and (d := distance(s, t)) <= k}
    assert got == want and len(want) > 50


def test_edit_candidates_are_far_below_the_square(spark):
    r = random.Random(9)
    rows = [(i, "h", "".join(r.choice("abcdefgh") for _ in range(40))) for i in range(800)]
    rows += [(1000 + i, "h", s[:20] + "x" + s[20:]) for i, _, s in rows[:100]]
    df = spark.createDataFrame(rows, "id long, block string, s string")
    assert 100 <= S.edit_candidates(df, 2).count() < 1000
    assert S.edit_pairs(df, 2).count() == 100


def test_classes_and_links(spark):
    rows = spark.createDataFrame([(3, "h", "aa"), (1, "h", "aa"), (2, "h", "ab"), (4, None, "aa"), (5, None, None)], "id long, block string, s string")
    rows = S.with_classes(rows, "id", ["block", "s"])
    pairs = S.edit_pairs(rows.filter("id = class_id").select("id", "block", "s"), 1)
    got = {x.id: (x.class_id, x.n_links, x.best) for x in S.links(rows, pairs, F.min("distance")).collect()}
    assert got == {1: (1, 1, 1), 3: (1, 1, 1), 2: (2, 1, 1), 4: (4, 0, None), 5: (5, 0, None)}
    empty = rows.limit(0)
    assert S.links(empty, S.edit_pairs(empty.select("id", "block", "s"), 2), F.min("distance")).collect() == []
