"""Elias-Fano coding and language-model scoring against plain dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import lm
from docflow.llm.common import crc_mod
from docflow.llm.elias_fano import EliasFano, pack, unpack


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300), st.lists(st.integers(-5, (1 << 40) + 5), max_size=50))
def test_elias_fano_round_trip(values, others):
    v = np.sort(np.array(values, dtype=np.int64))
    e = EliasFano.of(unpack(pack(EliasFano.encode(v).arrays())))
    assert list(e.get(np.arange(len(v)))) == list(v)
    q = np.array(values + others, dtype=np.int64)
    want = [int(np.searchsorted(v, x)) if x in set(values) else -1 for x in q]
    assert list(e.find(q)) == want


def test_elias_fano_is_compact():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 36, 100_000))
    e = EliasFano.encode(v)
    assert sum(a.nbytes for a in e.arrays()) * 8 / len(v) < 22      # 18 bits for the low part, two for the high


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def corpus(seed, n=150):
    r = random.Random(seed)
    vocab = ["the", "of", "The", "é", "Éa"] * 4 + [f"w{i}" for i in range(60)]
    rows = [(i, r.choice([" ", "\t\n", "\x0b"]).join(r.choice(vocab) for _ in range(r.choice([0, 1, 2, 10, 40])))) for i in range(n)]
    return rows + [(500, None), (501, "  "), (502, "rare unseen words"), (3, rows[3][1]), (None, "the of"), (503, "the of " * 20_000)]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def test_base_score_matches_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, n_tokens string")
    got = lm.score(df, crc_mod("doc_id", 10) != 0, head_size=20, max_entries=500).collect()
    train = Counter()
    for i, t in rows:
        if not held(i):
            train.update(words(t) + [None])
    total, kinds = sum(train.values()), len(train)
    want = []
    for i, t in rows:
        toks = words(t) + [None]
        want.append((i, held(i), len(toks), sum(train[w] > 0 for w in toks), total, sum(math.log10((train[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in toks)))
    key = lambda x: (str(x[0]), x[2])
    for a, b in zip(sorted(((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    better = [x for x in got if x.n_tokens > 10]
    assert all(x.score < 0 for x in got) and sum(x.score for x in better) > sum(x.base_score for x in better)


class Plain:
    """The same model from dictionaries: counts, thresholds, Witten-Bell."""

    def __init__(self, texts, head_size, max_entries):
        c = Counter(w for t in texts for w in words(t))
        n_end = len(texts)
        self.total, self.kinds = sum(c.values()) + n_end, len(c) + 1
        self.head = [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:head_size]]
        norm = self.total + 0.1 * (self.kinds + 1)
        self.p1 = {w: (c[w] + 0.1) / norm for w in self.head} | {"</s>": (n_end + 0.1) / norm}
        self.p1["<other>"] = 1 - sum(self.p1.values())
        seqs = [self.ids(t) for t in texts]
        two, three = Counter(), Counter()
        for s in seqs:
            two.update((a, b) for a, b in zip(s, s[1:]) if a != "<other>")
        self.two = self.keep(two, max_entries)
        for s in seqs:
            three.update(x for x in zip(s, s[1:], s[2:]) if x[:2] in self.two and x[1:] in self.two)
        self.three = self.keep(three, max_entries)
        self.sum2, self.kind2, self.sum3, self.kind3 = Counter(), Counter(), Counter(), Counter()
        for (a, _), n in two.items():
            self.sum2[a] += n
            self.kind2[a] += 1
        for (a, b, _), n in three.items():
            self.sum3[a, b] += n
            self.kind3[a, b] += 1
        self.kept2, self.kept3 = Counter(), Counter()
        for (a, _), n in self.two.items():
            self.kept2[a] += n
        for (a, b, _), n in self.three.items():
            self.kept3[a, b] += n

    def ids(self, t):
        known = set(self.head)
        return ["<s>"] + [w if w in known else "<other>" for w in words(t)] + ["</s>"]

    @staticmethod
    def keep(counts, most):
        least = 2
        while sum(n >= least for n in counts.values()) > most:
            least += 1
        return {k: n for k, n in counts.items() if n >= least}

    def bigram(self, a, b):
        whole = self.sum2[a] + self.kind2[a]
        spare = (whole - self.kept2[a]) / whole if whole else 1.0
        return self.two.get((a, b), 0) / max(whole, 1e-9) + spare * self.p1[b]

    def prob(self, a, b, c):
        low = self.bigram(b, c)
        if (a, b) not in self.two:
            return low
        total = max(self.sum3[a, b], self.two[a, b])
        whole = total + self.kind3[a, b] + (self.two[a, b] > self.sum3[a, b])
        spare = (whole - self.kept3[a, b]) / whole
        return self.three.get((a, b, c), 0) / whole + spare * low


@pytest.mark.parametrize("seed,head,most", [(2, 30, 10_000), (3, 12, 60)])
def test_trie_matches_a_plain_model(spark, tmp_path, seed, head, most):
    texts = [t for _, t in corpus(seed) if t != "the of " * 20_000]
    df = spark.createDataFrame([(t or "",) for t in texts], "t string")
    m = lm.train(df, lm.word_counts(df), head, most)
    plain = Plain(texts, head, most)
    assert m.head.words.to_pylist() == plain.head and (m.total, m.kinds) == (plain.total, plain.kinds)
    (tmp_path / "trie").write_bytes(m.trie)
    trie = lm.Trie.open(np.memmap(tmp_path / "trie", dtype=np.uint8, mode="r"))      # opens in place from a file
    assert trie.words.n == len(plain.two) and trie.ranks.n == len(plain.three)
    flat, per = lm.tokens(pa.array(texts))
    seq, at, doc = m.head.sequence(m.head.ids(flat)[0], per)
    logs = trie.logs(seq)
    names = plain.head + ["</s>", "<other>", "<s>"]
    off = []
    for i, (s, x) in enumerate(zip(seq, logs)):
        if s == m.head.start:
            assert x == 0
            continue
        a = names[seq[i - 2]] if seq[i - 1] != m.head.start else "<none>"
        off.append(abs(x - math.log10(plain.prob(a, names[seq[i - 1]], names[s]))))
    assert max(off) < 0.12 and np.mean(off) < 0.02          # the 8-bit codes


def test_model_without_pruning_sums_to_one(spark):
    texts = [t for _, t in corpus(4)][:100]
    df = spark.createDataFrame([(t or "",) for t in texts], "t string")
    m = lm.train(df, lm.word_counts(df), 15, 10_000)
    trie = lm.Trie.open(m.trie)
    r = random.Random(1)
    for _ in range(30):
        a, b = r.randrange(m.head.width - 2), r.randrange(m.head.width - 2)
        seqs = [[m.head.start, a, b, c] for c in range(m.head.width - 1)]
        p = sum(10 ** trie.logs(np.array(s))[-1] for s in seqs)
        assert p == pytest.approx(1.0, abs=0.05)


def test_no_training_text_and_empty_table(spark):
    df = spark.createDataFrame([(20, "a b"), (20, None)], "doc_id long, text string")
    from pyspark.sql import functions as F
    got = lm.score(df, F.lit(False)).collect()
    assert sorted((x.n_tokens, x.n_known, x.train_tokens) for x in got) == [(1, 0, 0), (3, 0, 0)] and all(x.held_out for x in got)
    assert lm.score(df.limit(0), F.lit(True)).collect() == []
