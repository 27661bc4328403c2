"""The sharded language model against plain dictionaries of all n-grams."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import lm, lm_shards
from docflow.llm.elias_fano import pack, unpack


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_scores(train, texts):
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        s = ["<s>", *words(t), "</s>"]
        one.update(s[1:])
        two.update(zip(s, s[1:]))
        three.update(zip(s, s[1:], s[2:]))
    total, kinds = sum(one.values()), len(one)
    n2, k2, n3, k3 = Counter(), Counter(), Counter(), Counter()
    for (a, _), n in two.items():
        n2[a] += n
        k2[a] += 1
    for (a, b, _), n in three.items():
        n3[a, b] += n
        k3[a, b] += 1
    out = []
    for t in texts:
        s, logs = [None, "<s>", *words(t), "</s>"], 0.0
        for a, b, c in zip(s, s[1:], s[2:]):
            p = (one[c] + 0.1) / (total + 0.1 * (kinds + 1))
            p = (two[b, c] + k2[b] * p) / (n2[b] + k2[b]) if n2[b] else p
            p = (three[a, b, c] + k3[a, b] * p) / (n3[a, b] + k3[a, b]) if n3[a, b] else p
            logs += math.log10(p)
        out.append(logs)
    return out


def close(got, want, tokens):
    """The 8-bit codes put a token's log10 off by at most 0.03, on average by far less."""
    return abs(got - want) <= 0.03 * min(tokens, 3) + 0.004 * tokens


@pytest.mark.parametrize("shard,chunk", [(lm_shards.SHARD, lm_shards.CHUNK), (100, 50)])
def test_score_counts_every_ngram(spark, monkeypatch, shard, chunk):
    monkeypatch.setattr(lm_shards, "SHARD", shard)
    monkeypatch.setattr(lm_shards, "CHUNK", chunk)
    monkeypatch.setattr(lm_shards, "PIECE", chunk)
    monkeypatch.setattr(lm_shards, "OPEN", 3)
    r = random.Random(7)
    vocab = ["the", "Of", "é"] * 8 + [f"w{i}" for i in range(200)]
    texts = [" ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 2, 9, 40]))) for _ in range(150)]
    texts += [None, "  ", "the of " * 3000, "unseen words here", "w1 unseen the of"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in lm.score(df, F.col("doc_id") < 145).collect()}
    want = plain_scores(texts[:145], texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert close(got[i].score, w, got[i].n_tokens), (i, got[i].score, w, got[i].n_tokens)


def test_default_model_is_not_bounded(spark, monkeypatch):
    """Neither the head nor the number of n-grams of the bounded trie counts."""
    monkeypatch.setattr(lm, "HEAD", 2)
    monkeypatch.setattr(lm, "MAX_ENTRIES", 2)
    texts = ["a b c d e", "a b c d f", "x y z", "a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in lm.score(df, F.col("doc_id") < 3).collect()}
    for i, w in enumerate(plain_scores(texts[:3], texts)):
        assert got[i].score == pytest.approx(w, abs=1e-6)      # so few values have codes of their own


def test_trie_holds_every_ngram_relative_to_its_context():
    r = np.random.default_rng(3)
    grams = np.unique(r.integers(0, [40, 60, 1 << 30], (5000, 3)), axis=0)
    grams[:2500, 2] %= 25
    grams = np.unique(grams, axis=0)
    a, b, c = grams.T
    n = r.integers(1, 2000, len(grams))
    arrays = unpack(pack(lm_shards.Trie.build(a, b, c, n)))
    trie = lm_shards.Trie(arrays)
    contexts, which = np.unique(grams[:, :2], axis=0, return_inverse=True)
    assert trie.node(*contexts.T).tolist() == list(range(len(contexts)))
    leaf = trie.leaf(which, c)
    assert leaf.tolist() == list(range(len(grams)))
    total, kinds = np.bincount(which, n), np.bincount(which)
    for codes, means, want in ((trie.count, trie.counts, np.log10(total)), (trie.back, trie.backs, np.log10(kinds / (total + kinds))),
                               (trie.share, trie.shares, np.log10(n / (total + kinds)[which]))):
        assert np.abs(means[codes] - want).max() <= np.ptp(want) / 256
    # what is not there is not found, also where another context has the value
    held, pairs = set(map(tuple, grams.tolist())), set(map(tuple, contexts.tolist()))
    wrong = [(k, x) for k in range(len(contexts)) for x in (0, 3, 24, 1 << 29, int(c[k])) if (*contexts[k].tolist(), x) not in held]
    assert set(trie.leaf(*np.array(wrong).T).tolist()) == {-1}
    other = np.array(sorted({(x, y) for x in range(45) for y in range(70)} - pairs))
    assert set(trie.node(*other.T).tolist()) == {-1}


def test_words_after_a_context(spark):
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(12)]
    texts = [" ".join(r.choice(vocab) for _ in range(20)) for _ in range(40)]
    after = [f"w1 w2 {w}" for w in [*vocab, "unseen"]] + ["w1 w2"]
    df = spark.createDataFrame(list(enumerate([*texts, *after])), "doc_id long, text string")
    got = {x.doc_id: x.score for x in lm.score(df, F.col("doc_id") < 40).collect()}
    for i, w in enumerate(plain_scores(texts, after)):
        assert got[40 + i] == pytest.approx(w, abs=0.05)
