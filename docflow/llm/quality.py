"""Quality classifier: an additive model with pairwise interactions.

Every text is turned into a row of numbers (shares of character classes, word
and line repetition, lengths).  Each feature is cut into quantile bins, and
boosting runs in cycles: one shallow tree (a few splits of one feature's
bins) at a time, feature after feature, each fitted to what the others leave.
The trees of a feature add up to one lookup table.  Then the pairs of
features whose joint bins explain most of the rest get two-way tables in the
same manner.  A score is the sum of the looked-up values, so scoring is
vectorised bin additions.

Features are computed for all rows on the executors and written once; the fit
uses at most ``max_rows`` labelled rows (lowest hash of the id), of which the
driver gets the numbers only.

Defined cases: a null text counts as empty and gets a score from its zero
features; without labels, or with one class only, every score is the
(smoothed) share of class 1; repeated rows score alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize, opened, sample_ids, share

MAX_ROWS = 40_000
NAMES = ("log_bytes", "log_words", "word_len", "letters", "upper", "digits", "space", "punct", "symbols", "bars", "marks", "other",
         "title_words", "upper_words", "mixed_words", "unique_words", "top_word", "same_next", "unique_pairs", "log_lines", "unique_lines",
         "line_words", "ends_well", "sentence_words", "short_words", "long_words", "no_vowel")

_CLASS = np.full(256, 7, dtype=np.uint8)          # 7: bytes above ASCII (letters of other scripts)
_CLASS[:128] = 6                                  # 6: controls
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b" \t\n\r\x0b\x0c", 3),
                   (b".,;:'\"()-?", 4), (b"#$%&*+<=>@[\\]^_`{}~/", 5), (b"|", 8), (b"!", 9)):
    _CLASS[list(_chars)] = _k
_SENTENCE = re.compile(r"[.!?]+")


def features(text: str) -> list[float]:
    """The numbers of one text, in the order of ``NAMES``."""
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    c = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10) / n
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(1, len(lines))
    pairs = list(zip(words, words[1:]))
    title = sum(map(str.istitle, words)) / m
    upper = sum(w.isupper() and len(w) > 1 for w in words) / m
    alpha = sum(map(str.isalpha, words)) / m
    lens = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    low = text.lower()
    vowels = sum(map(low.count, "aeiouyäöüéèêàáíóúâîôû")) / n
    return [np.log1p(len(raw)), np.log1p(len(words)), float(lens.mean()), c[0] + c[7], c[1], c[2], c[3], c[4], c[5], c[8], c[9], c[6],
            title, upper, alpha, len(counts) / m, max(counts.values(), default=0) / m,
            sum(a == b for a, b in pairs) / m, len(set(pairs)) / max(1, len(pairs)), np.log1p(len(lines)), len(set(lines)) / k,
            len(words) / k, sum(x.rstrip()[-1] in ".!?\"')" for x in lines) / k, len(words) / max(1, len(_SENTENCE.findall(text))),
            float((lens <= 3).mean()), float((lens >= 15).mean()), vowels]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``f`` (array of float) for every row."""
    def run(batches):
        for b in batches:
            rows = [features(t or "") for t in b.column("text").to_pylist()]
            flat = np.asarray(rows, dtype=np.float32).reshape(len(rows), len(NAMES))
            f = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES)), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), f], names=["doc_id", "f"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, f array<float>")


class Additive:
    """Bin edges, one lookup table a feature and one a chosen pair."""

    def __init__(self, base: float, edges: list[np.ndarray], tables: list[np.ndarray], pairs: list[tuple[int, int, np.ndarray]], pair_bins: list[np.ndarray]):
        self.base, self.edges, self.tables, self.pairs, self.pair_bins = base, edges, tables, pairs, pair_bins

    def score(self, x: np.ndarray) -> np.ndarray:
        at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[at[j]]
        for i, j, t in self.pairs:
            z += t[self.pair_bins[i][at[i]], self.pair_bins[j][at[j]]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _steps(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values of a tree of at most ``leaves`` leaves over ordered bins with
    gradient sums ``g`` and weights ``h``: greedy splits by gain."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    parts = [(0, len(g))]
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            gain = (cg[cut] - cg[a]) ** 2 / (ch[cut] - ch[a] + ridge) + (cg[b] - cg[cut]) ** 2 / (ch[b] - ch[cut] + ridge) - value(a, b)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], p, int(cut[k]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.15, leaves: int = 3, ridge: float = 5.0,
        n_pairs: int = 10, pair_cells: int = 8, pair_rounds: int = 40) -> Additive:
    """Cyclic boosting of per-feature tables, then of tables of the best pairs."""
    n, m = x.shape if len(x) else (0, len(NAMES))
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for j in range(m)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    pair_bins = [np.arange(len(e) + 1) * pair_cells // (len(e) + 1) for e in edges]
    if n == 0 or y.min() == y.max():
        return Additive(base, edges, tables, [], pair_bins)
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    z = np.full(n, base)
    slope = lambda: (y - (p := 1 / (1 + np.exp(-z))), p * (1 - p))
    for _ in range(rounds):
        for j in range(m):
            g, h = slope()
            t = rate * _steps(np.bincount(at[j], g, len(tables[j])), np.bincount(at[j], h, len(tables[j])), leaves, ridge)
            tables[j] += t
            z += t[at[j]]
    g, h = slope()
    cell = lambda i, j: pair_bins[i][at[i]] * pair_cells + pair_bins[j][at[j]]

    def gain(i, j):
        a, b = np.bincount(cell(i, j), g, pair_cells ** 2), np.bincount(cell(i, j), h, pair_cells ** 2)
        return float((a ** 2 / (b + ridge)).sum())
    chosen = sorted(combinations(range(m), 2), key=lambda p: -gain(*p))[:n_pairs]
    pairs = [(i, j, np.zeros((pair_cells, pair_cells))) for i, j in chosen]
    cells = [cell(i, j) for i, j in chosen]
    for _ in range(pair_rounds):
        for (_, _, t), c in zip(pairs, cells):
            g, h = slope()
            step = rate * np.bincount(c, g, pair_cells ** 2) / (np.bincount(c, h, pair_cells ** 2) + ridge)
            t += step.reshape(t.shape)
            z += step[c]
    return Additive(base, edges, tables, pairs, pair_bins)


def train(table: DataFrame, labels: DataFrame, label_col: str, max_rows: int = MAX_ROWS, **params) -> Additive:
    """Fit on the rows of ``table`` (doc_id, f) that ``labels`` names; null labels are left out."""
    lab = sample_ids(labels.filter(F.col(label_col).isNotNull()).select("doc_id", F.col(label_col).cast("double").alias("y")), "doc_id", max_rows)
    rows = table.join(F.broadcast(lab), "doc_id").select("f", "y").orderBy(F.xxhash64("f"), "y").limit(max_rows)
    got = rows.toArrow()
    x = got.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES)) if got.num_rows else np.empty((0, len(NAMES)))
    return fit(x.astype(np.float64), got.column("y").to_numpy(), **params)


def score(table: DataFrame, model: Additive) -> DataFrame:
    """(doc_id, f) -> (doc_id, score)."""
    held = share(table.sparkSession, model)

    def run(batches):
        fitted = opened(held)
        for b in batches:
            x = b.column("f").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fitted.score(x))], names=["doc_id", "score"])
    return table.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             max_rows: int = MAX_ROWS, **params) -> DataFrame:
    """(doc_id, score) for every row of ``docs``, learning from ``labels``
    (doc_id and ``label_col``, 0 or 1)."""
    table = materialize(feature_table(docs, id_col, text_col), "quality-features")
    return score(table, train(table, labels, label_col, max_rows, **params))
