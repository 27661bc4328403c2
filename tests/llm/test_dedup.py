"""Exact and SimHash dedup against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from docflow.llm import components, exact_dedup, simhash

DOCS = "doc_id long, text string, keep_id string, fp string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)


def test_exact_matches_brute_force(spark):
    r = random.Random(1)
    texts = [None, "", "a", "b" * 300, "b" * 299 + "c", "é", "long " * 4000, "a "]
    rows = [(i, r.choice(texts)) for i in range(120)] + [(7, "a"), (7, "a"), (None, "a"), (None, None)]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = sorted(((i, max(x for x in groups[t or ""] if x is not None), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=str)
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got), key=str) == want
    kept = [x for x in got if x.kept]
    assert len(kept) == len(groups) and all(x.doc_id == x.keep_id for x in kept)   # one of each group, repeats included


def test_exact_singletons_and_null_ids(spark):
    got = {x.text_sha256: x for x in exact_dedup.exact_dedup(frame(spark, [(1, "a"), (None, "b"), (None, "c"), (None, "c")])).collect()}
    b = got[hashlib.sha256(b"b").hexdigest()]
    assert b.kept and b.keep_id is None and b.group_size == 1
    assert exact_dedup.exact_dedup(frame(spark, [])).collect() == []


def test_drop_exact_duplicates_keeps_columns_and_one_row(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, "c"), (None, "c"), (4, None), (5, "")]
    out = exact_dedup.drop_exact_duplicates(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "keep_id", "fp"]
    assert sorted(((x.doc_id, x.text) for x in out.collect()), key=str) == sorted([(2, "a"), (3, "b"), (None, "c"), (5, "")], key=str)


def brute_fp(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def near_texts(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["Éa", "Übér", "x y"]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 40, 200]))] for _ in range(12)]
    out = []
    for i in range(n):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 1, 2])):
            words[r.randrange(len(words))] = r.choice(vocab)
        out.append((i, r.choice([" ", "\n", "  "]).join(words)))
    return out


def brute_components(fps, bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bits,dense", [(4, 128), (4, 2), (3, 2), (2, 1), (0, 1)])
def test_simhash_matches_brute_force(spark, bits, dense):
    rows = near_texts(3, 150) + [(150, None), (151, ""), (152, " \t\x0b"), (153, "ONE two"), (154, "one TWO"), (155, "word " * 9000)]
    got = {x.id: x for x in simhash.near_duplicates(frame(spark, rows), max_bits=bits, dense=dense).collect()}
    fps = {i: brute_fp(t) for i, t in rows}
    assert {i: x.fp % (1 << 64) for i, x in got.items()} == fps
    assert {i: x.component_id for i, x in got.items()} == brute_components(fps, bits)


def test_dense_and_pairwise_links_agree_on_a_ball(spark):
    r = random.Random(5)
    centre = r.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3]))) for _ in range(300)} | {r.getrandbits(64) for _ in range(50)}
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_components({x: x % (1 << 64) for x in signed}, 4)
    for dense in (3, 10_000):
        comps = {x.node: x.root for x in components.connected_components(simhash.links(df, 4, dense)).collect()}
        assert {x: comps.get(x, x) for x in signed} == want


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 300), (5, 5)]
    got = {x.node: x.root for x in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_drop_near_duplicates(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(3, text), (1, text + " "), (2, text.upper()), (9, "something else entirely here"), (None, "null id stays by itself ok")]
    out = simhash.drop_near_duplicates(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "keep_id", "fp"]
    assert sorted((x.doc_id for x in out.collect()), key=str) == sorted([1, 9, None], key=str)
    same_id = [(1, text), (1, text + "  "), (1, text + "   ")]
    assert simhash.drop_near_duplicates(frame(spark, same_id)).count() == 1
    assert simhash.drop_near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 5)


def test_exact_dedup_keeps_columns_with_helper_names(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 7)], "doc_id long, text string, __docflow_key int")
    got = exact_dedup.drop_exact_duplicates(docs)
    assert got.columns == docs.columns and sorted(tuple(x) for x in got.collect()) == [(2, "a", 6), (3, "b", 7)]
