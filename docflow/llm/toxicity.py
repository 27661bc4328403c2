"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses, and each word becomes a symbol: insult, threat,
target, negation, reported speech, or other.  Small transducers read the
symbols of a clause.  Each one opens a window after its trigger and marks the
insults and threats inside it (targeted, negated, reported); their composition
is one machine that reads a clause once.  A second target transducer reads it
backwards, for targets that follow.  A matched clause scores the weights of
its insults and threats, times the factors of their marks.  A text's score is
a logistic function of its clause scores.

The word weights and the final function are learned from at most
``max_rows`` labelled texts (lowest hash of the id): a word joins the insult
lexicon if it is significantly tied to toxic texts and occurs in varied
contexts there (so the words of a text that was copied often do not), and a
prefix shared by many such words becomes a pattern ``prefix*``.  Word counts
are Spark aggregations over distinct texts; the lexicon holds at most
``max_terms`` entries, which bounds what is sent to the tasks.  Scoring reads
every whole text.

Defined cases: a null or empty text has no clause and gets the score of such
texts; without labels, or with one class only, the seed lists decide with
fixed weights; rows that repeat score alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize, opened, sample_ids, share, text_of

MAX_ROWS = 20_000
MAX_TERMS = 20_000
PREFIXES = (4, 5, 6)
EVIDENCE = 14.0        # nats of evidence a word or prefix needs

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Seed lists: fixed values.
SEEDS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown imbecile crétin débile ordure dummkopf abschaum trottel imbécil estúpido basura",
    THREAT: "kill hurt destroy beat burn shoot stab tuer frapper détruire töten schlagen zerstören matar golpear destruir",
    TARGET: "you your he she they them him her tu toi vous ton votre du dich dir ihr euch usted ustedes ti él ella ellos",
    NEGATION: "not never no nobody isn't aren't ne pas jamais aucun nicht kein keine nie nunca ningún jamás",
    REPORT: "said says say told claims claimed called calls wrote quoted dit disait écrit sagte sagt schrieb dijo dice escribió",
}
#: Mark bits and what a marked insult or threat is worth against a bare one.
TARGETED, NEGATED, REPORTED = 1, 2, 4
FACTOR = {TARGETED: 1.5, NEGATED: 0.6, REPORTED: 0.6}
WINDOW = {TARGET: (3, TARGETED), NEGATION: (2, NEGATED), REPORT: (4, REPORTED)}
SYMBOLS = 6 * 8        # tag * 8 + marks

TOKEN = re.compile(r"[^\W\d_]+|[.,;:!?|\n]")
BREAK = frozenset(".,;:!?|\n")


class Transducer:
    """Deterministic: ``step[state, symbol]`` and ``out[state, symbol]``."""

    def __init__(self, step: np.ndarray, out: np.ndarray):
        self.step, self.out = step, out

    @classmethod
    def window(cls, trigger: int) -> Transducer:
        """Marks insults and threats in the words after a trigger."""
        width, mark = WINDOW[trigger]
        step = np.zeros((width + 1, SYMBOLS), dtype=np.int64)
        out = np.tile(np.arange(SYMBOLS), (width + 1, 1))
        for state in range(width + 1):
            for s in range(SYMBOLS):
                tag = s // 8
                step[state, s] = width if tag == trigger else max(0, state - 1)
                if state and tag in (INSULT, THREAT):
                    out[state, s] = s | mark
        return cls(step, out)

    def compose(self, after: Transducer) -> Transducer:
        """What this one writes is read by ``after``."""
        n, m = len(self.step), len(after.step)
        step = np.zeros((n * m, SYMBOLS), dtype=np.int64)
        out = np.zeros_like(step)
        for a in range(n):
            for b in range(m):
                mid = self.out[a]
                step[a * m + b] = self.step[a] * m + after.step[b, mid]
                out[a * m + b] = after.out[b, mid]
        return Transducer(step, out)

    def run(self, symbols: list[int]) -> list[int]:
        state, said = 0, []
        for s in symbols:
            said.append(int(self.out[state, s]))
            state = int(self.step[state, s])
        return said


FORWARD = Transducer.window(TARGET).compose(Transducer.window(NEGATION)).compose(Transducer.window(REPORT))
BACKWARD = Transducer.window(TARGET)


class Grammar:
    """Lexicon (word -> (tag, weight)), prefix patterns (prefix -> weight)
    and the weights of the final function."""

    def __init__(self, lexicon: dict[str, tuple[int, float]], prefixes: dict[str, float], final: np.ndarray):
        self.lexicon, self.prefixes, self.final, self.memo = lexicon, prefixes, final, {}

    def look(self, word: str) -> tuple[int, float] | None:
        found = self.lexicon.get(word)
        if found is None:
            for n in PREFIXES:
                if len(word) > n and (w := self.prefixes.get(word[:n])):
                    found = (INSULT, w)
        return found

    def clauses(self, text: str) -> list[float]:
        """Scores of the matched clauses."""
        toks = TOKEN.findall(text.lower())
        memo, hot = self.memo, []
        if len(memo) > 300_000:
            memo.clear()
        for i, w in enumerate(toks):
            try:
                found = memo[w]
            except KeyError:
                found = memo[w] = self.look(w)
            if found is not None and found[0] in (INSULT, THREAT):
                hot.append(i)
        scores, end = [], -1
        for i in hot:
            if i < end:
                continue
            start = i
            while start > 0 and toks[start - 1] not in BREAK:
                start -= 1
            end = i
            while end < len(toks) and toks[end] not in BREAK:
                end += 1
            scores.append(self.clause(toks[start:end]))
        return [s for s in scores if s > 0]

    def clause(self, words: list[str]) -> float:
        found = [self.memo.get(w) or (OTHER, 0.0) for w in words]
        symbols = FORWARD.run([tag * 8 for tag, _ in found])
        symbols = BACKWARD.run(symbols[::-1])[::-1]
        total = 0.0
        for (tag, weight), s in zip(found, symbols):
            if tag == THREAT and not s & TARGETED:
                continue                       # a threat needs its target
            if tag in (INSULT, THREAT):
                total += weight * math.prod(f for mark, f in FACTOR.items() if s & mark)
        return total

    def features(self, text: str | None) -> list[float]:
        scores = self.clauses(text) if text else []
        if not scores:
            return [0.0] * 4
        best, total = max(scores), sum(scores)
        return [1.0, min(best, 20.0) / 5, math.log1p(total), min(len(scores), 5) / 5]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.final, [1.0, *self.features(text)]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def seed_lexicon() -> dict[str, tuple[int, float]]:
    return {w: (tag, 4.0 if tag in (INSULT, THREAT) else 0.0) for tag, words in reversed(SEEDS.items()) for w in words.split()}


def occurrences(texts: DataFrame) -> DataFrame:
    """(t, y) -> (word, pos, neg): texts of each class with the word."""
    def run(batches):
        from collections import Counter
        held = (Counter(), Counter())

        def out():
            keys = list(held[0].keys() | held[1].keys())
            cols = [pa.array([c[k] for k in keys], pa.int64()) for c in held]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), cols[1], cols[0]], names=["word", "pos", "neg"])
        for b in batches:
            for t, y in zip(b.column("t").to_pylist(), b.column("y").to_pylist()):
                held[int(y >= 0.5)].update(w for w in set(TOKEN.findall(t.lower())) if w not in BREAK)
            if len(held[0]) + len(held[1]) > 300_000:
                yield out()
        yield out()
    return texts.select("t", "y").mapInArrow(run, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def evidence(base: float):
    """Nats by which the share of toxic texts speaks against ``base``; 0 if it is below."""
    n = F.col("pos") + F.col("neg")
    p = F.col("pos") / n
    part = lambda q, b: F.when(q > 0, q * F.log(q / b)).otherwise(0.0)
    return F.when(p > base, n * (part(p, F.lit(base)) + part(1 - p, F.lit(1 - base)))).otherwise(0.0)


def contexts(texts: DataFrame, words: set[str]) -> DataFrame:
    """(t) -> (word, n): distinct pairs of neighbours of each of ``words``."""
    held = share(texts.sparkSession, words)

    def run(batches):
        wanted = opened(held)
        for b in batches:
            seen = set()
            for t in b.column("t").to_pylist():
                toks = ["", *TOKEN.findall(t.lower()), ""]
                seen.update((toks[i], toks[i - 1] + " " + toks[i + 1]) for i in range(1, len(toks) - 1) if toks[i] in wanted)
            rows = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.string())], names=["word", "at"])
    return texts.select("t").mapInArrow(run, "word string, at string").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps, pulled to ``prior``."""
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


DEFAULT = np.array([-3.0, 1.0, 1.0, 1.0, 1.0])     # of the final function, before learning


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> Grammar:
    """Grammar learned from ``labels`` (doc_id, ``label_col``: 0 or 1)."""
    lab = sample_ids(labels.filter(F.col(label_col).isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("double").alias("y")), "id", max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t")).join(F.broadcast(lab), "id")
    sample = materialize(rows.groupBy(F.xxhash64("t").alias("h")).agg(F.first("t").alias("t"), F.avg("y").alias("y")), "toxic-sample")
    pos, n = sample.agg(F.count_if(F.col("y") >= 0.5), F.count(F.lit(1))).first()
    lexicon = seed_lexicon()
    if not 0 < pos < n:
        return Grammar(lexicon, {}, DEFAULT)
    base = pos / n
    counts = materialize(occurrences(sample), "toxic-words")
    tied = counts.filter((evidence(base) >= EVIDENCE) & (F.col("pos") >= 0.6 * (F.col("pos") + F.col("neg"))))
    weight = {r.word: (r.pos, r.neg) for r in tied.orderBy(F.desc("pos"), "word").limit(max_terms).collect()}
    varied = {r.word: r.n for r in contexts(sample.filter("y >= 0.5"), set(weight)).collect()}
    odds = lambda a, b: min(8.0, math.log((a + 0.5) / (pos + 1)) - math.log((b + 0.5) / (n - pos + 1)))
    for w, (a, b) in weight.items():
        if varied.get(w, 0) >= 0.6 * a and w not in lexicon:
            lexicon[w] = (INSULT, odds(a, b))
    for w, (tag, _) in list(lexicon.items()):
        if tag == INSULT and w in weight:
            lexicon[w] = (INSULT, odds(*weight[w]))
    prefixes = {}
    for k in PREFIXES:
        stems = (counts.filter(F.length("word") > k).groupBy(F.substring("word", 1, k).alias("stem"))
                 .agg(F.count_if(F.col("pos") > 0).alias("kinds"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
                 .filter((F.col("kinds") >= 6) & (evidence(base) >= 2 * EVIDENCE) & (F.col("pos") >= 0.98 * (F.col("pos") + F.col("neg")))))
        for r in stems.orderBy(F.desc("pos"), "stem").limit(max_terms).collect():
            prefixes[r.stem] = odds(r.pos, r.neg)
    held = share(docs.sparkSession, Grammar(lexicon, prefixes, DEFAULT))

    def run(batches):
        g = opened(held)
        for b in batches:
            x = [g.features(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("y")], names=["x", "y"])
    got = sample.select("t", "y").mapInArrow(run, "x array<double>, y double").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(DEFAULT) - 1)
    final = logistic(np.column_stack([np.ones(len(x)), x]), (got.column("y").to_numpy() >= 0.5).astype(float), DEFAULT)
    return Grammar(lexicon, prefixes, final)


def score(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``__docflow_score`` at its end."""
    held = share(docs.sparkSession, grammar)

    @F.arrow_udf("double")
    def toxic(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        g = opened(held)
        for t in parts:
            yield pa.array([g.score(x) for x in t.to_pylist()], pa.float64())
    return docs.withColumn("__docflow_score", toxic(F.col(text_col).cast("string")))


def scores(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row."""
    held = share(docs.sparkSession, grammar)

    def run(batches):
        g = opened(held)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g.score(t) for t in b.column("t").to_pylist()], pa.float64())], names=["doc_id", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, "doc_id long, score double")
