"""Vector codes against plain loops."""

import math
import random

import numpy as np
import pytest

from docflow.llm import vector_codes as V

ROWS = "vec_id long, embedding array<float>, label int, error string, codes int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1) for i, v, l in rows], ROWS)


def floor_of(x):
    return math.floor(float(np.float32(x)) * 4096)


def brute(rows, parts, entries, rounds):
    kept = [(i, [floor_of(x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    length = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    kept = [(i, v + [0] * (length - len(v)), l) for i, v, l in kept]
    w = length // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for _, v, _ in kept:
                x = v[p * w:(p + 1) * w]
                got.setdefault(near(x, books[p])[1], []).append(x)
            for j, xs in got.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for i, v, l in kept:
        found = [near(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, l, [j for _, j in found], sum(d for d, _ in found)))
    return out, books


def vectors(seed, n, dim):
    r = random.Random(seed)
    return [(i, [r.uniform(-1, 1) for _ in range(dim)], r.choice([None, 1, 2])) for i in range(n)]


def key(r):
    return (r[0] is None, r[0] or 0, r[3], r[2], r[1] is None, r[1] or 0)


HOT = [0.25, -0.5, 0.125, 0.0, 1.0, -1.0, 0.5, 0.75]


@pytest.mark.parametrize("rows,parts,entries", [
    (vectors(1, 60, 24), 8, 16),                                    # parts of 3, padded to 4
    (vectors(2, 5, 8), 4, 16),                                      # fewer vectors than entries
    ([(i, HOT, 1) for i in range(40)] + vectors(3, 40, 8), 2, 5),   # a third are copies: entries tie
    ([(None, HOT, None), (1, None, 1), (2, [1.0, None] + HOT[2:], 1), (3, [float("nan")] + HOT[1:], 2), (4, [float("-inf")] + HOT[1:], 2),
      (5, HOT[:3], None), (5, HOT[:3], None), (6, [], 1)], 2, 4),
])
def test_codes_are_those_of_plain_loops(spark, rows, parts, entries):
    want, books = brute(rows, parts, entries, 3)
    coded, got = V.compress(frame(spark, rows).repartition(3), parts=parts, entries=entries, rounds=3)
    assert [e.tolist() for e in got.entries] == books
    assert sorted(((r.id, r.label, r.codes, r.error) for r in coded.collect()), key=key) == sorted(want, key=key)
    sums = {}
    for _, l, _, e in want:
        sums[l] = sums.get(l, 0) + e
    assert {(r.label, r.label_error) for r in V.label_errors(coded).collect()} == set(sums.items())


def test_transform_keeps_distances_and_orders_by_sign_changes():
    order = V.sequency(8)
    rows = V.walsh(np.eye(8, dtype=np.int64), order)                # column k: the k-th Walsh function
    assert [(int((rows[1:, k] != rows[:-1, k]).sum())) for k in range(8)] == list(range(8))
    x = np.random.default_rng(1).integers(-9999, 9999, (50, 5))
    t = V.walsh(x, order)
    assert (t ** 2).sum(axis=1).tolist() == (8 * (x ** 2).sum(axis=1)).tolist()


def test_nearest_takes_the_lower_index_of_ties():
    e = V.walsh(np.array([[5, 5], [1, 3], [3, 1], [1, 3]]), V.sequency(2))
    got, d = V.nearest(V.walsh(np.array([[1, 3], [2, 2], [9, 9]]), V.sequency(2)), e)
    assert got.tolist() == [1, 1, 0] and (d // 2).tolist() == [0, 2, 32]


def test_empty_and_too_large(spark):
    coded, books = V.compress(frame(spark, [(1, None, 1)]))
    assert books is None and coded.collect() == [] and V.label_errors(coded).collect() == []
    with pytest.raises(ValueError, match="too large"):
        V.compress(frame(spark, [(1, [1e30] * 8, 1)]))
    biggest = [8191.0] * 64
    got, _ = V.compress(frame(spark, [(1, biggest, 1), (2, [-x for x in biggest], 1)]), entries=1, rounds=1)
    assert [r.error for r in got.collect()] == [64 * (8191 * 4096) ** 2] * 2
