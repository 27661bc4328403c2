"""Manifests against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from docflow.llm import merkle

COLS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, idx string, h0 int, steps int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], DOCS)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """(root, siblings of each leaf by level)."""
    sib, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, a in enumerate(at):
            if (a ^ 1) < len(level):
                sib[k].append(level[a ^ 1])
            at[k] = a // 2
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], sib


def brute(rows):
    by = {}
    for i, t, l, s, n in rows:
        by.setdefault(l, []).append((i, H(*map(field, (i, s, l, n, t)))))
    langs = sorted(by, key=lambda l: (l is not None, (l or "").encode()))
    subs, parts = {}, {}
    for l in langs:
        held = sorted(by[l], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        subs[l], sib = tree([h for _, h in held])
        parts[l] = [(i, h, s) for (i, h), s in zip(held, sib)]
    root, top = tree([subs[l] for l in langs])
    return [(i, h, subs[l], root, "".join(s + top[k])) for k, l in enumerate(langs) for i, h, s in parts[l]]


def corpus(sizes):
    rows = []
    for l, n in sizes.items():
        rows += [(len(rows) * 37 % 1009 + i, f"täxt {i}" * (i % 4) if i % 5 else None, l, None if i % 3 else "s", i if i % 4 else None) for i in range(n)]
    return rows


@pytest.mark.parametrize("rows", [
    corpus({"de": 1}),
    corpus({"de": 2, None: 3, "é": 1, "z": 17, "en": 300}),
    corpus({"a": 16, "b": 256, "c": 257}),
    [(1, "same", "x", "s", 4)] * 40 + [(None, "", "x", "s", None), (None, None, "x", None, 0), (1, "other " * 50000, "x", "s", 4)],
    corpus({f"l{k}": 2 for k in range(40)}),
])
def test_manifest_is_the_plain_tree(spark, rows):
    out = merkle.manifest(frame(spark, rows).repartition(4), COLS)
    got = out.select("doc_id", "leaf", "subroot", "root", merkle.siblings("steps").alias("s"), merkle.fold(F.col("leaf"), "steps").alias("f")).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:5]))
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(brute(rows), key=key)
    assert {r.f for r in got} == {got[0].root}


def test_a_changed_row_is_found(spark):
    rows = corpus({"de": 20, "en": 70})
    changed = merkle.digest(*[merkle.field(c) for c in ("doc_id", "source", "lang", F.when(F.col("doc_id") % 2 == 0, F.lit(-1)).otherwise(F.col("n_chars")), "text")])
    out = merkle.manifest(frame(spark, rows), COLS, extra={"changed": changed})
    for r in out.select("doc_id", "root", merkle.fold(F.col("changed"), "steps").alias("f")).collect():
        assert (r.f == r.root) == (r.doc_id % 2 == 1)


def test_empty_table(spark):
    out = merkle.manifest(frame(spark, []), COLS)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "steps"] and out.collect() == []
