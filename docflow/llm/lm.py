"""Language-model scoring with Elias-Fano coded n-grams.

``score`` uses the whole model of ``lm_shards``: all words, bigrams and
trigrams.  ``train`` builds a bounded model in a single buffer, for a caller
that asks for one by its size:

Training counts every token of every training text.  The ``head`` most
frequent words (65,536) have ids of their own in the trie; all others share
one class inside n-grams and are told apart by their exact counts, so the
vocabulary is open.  Bigrams and then trigrams are counted over the whole
training set and smoothed by interpolated Witten-Bell; each level keeps the
n-grams whose count reaches the lowest threshold that holds at most
``max_entries`` of them (the model's size, and so the bound of what is sent to
the tasks), and the mass of the others goes to the shorter context.

The trie has three levels.  Child ranges are Elias-Fano coded monotone
pointers; the successors of all contexts are one Elias-Fano sequence that
grows from context to context; a trigram's last word is stored as its rank
among the successors of the shorter context and found by successor search.
Probabilities and back-off weights are quantised to 8 bits a level.  The
whole trie is one flat buffer that opens in place, from a broadcast or from a
memory-mapped file.

Words outside the head are looked up by a join on the word, for their exact
counts.

Defined cases: a null text is empty and still has its end token; rows that
repeat are scored each; without training texts every token is unknown; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm import lm_shards
from docflow.llm.common import materialize, opened, share, text_of
from docflow.llm.elias_fano import EliasFano, pack, unpack

HEAD = 65_536
MAX_ENTRIES = 1_000_000
ALPHA = 0.1
CHUNK = 8_000_000      # positions whose n-grams are counted in a task before they are handed on


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array, and the number of words of each."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(full)])
    off = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(pa.array(full)), np.diff(ends[off])


GATHER = 32 << 20      # bytes of words that a task counts at a time


def word_counts(texts: DataFrame) -> DataFrame:
    """(t) -> (word, n): every distinct word, and the end token as ``''``."""
    def run(batches):
        held, size, ends = [], 0, 0

        def out():
            vc = pa.chunked_array(held, pa.large_string()).value_counts()
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([vc.field(0).cast(pa.string()), pa.array([""])]),
                 pa.concat_arrays([vc.field(1).cast(pa.int64()), pa.array([ends], pa.int64())])], names=["word", "n"])
        for b in batches:
            flat, per = tokens(b.column("t"))
            held.append(flat)
            size, ends = size + flat.nbytes, ends + len(per)
            if size > GATHER:
                yield out()
                held, size, ends = [], 0, 0
        if ends:
            yield out()
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Head:
    """Ids of the frequent words: 0 to size - 1; then the end token, the
    class of all other words and the start mark."""

    def __init__(self, words: list[str]):
        self.words, self.size = pa.array(words, pa.large_string()), len(words)
        self.end, self.other, self.start, self.width = self.size, self.size + 1, self.size + 2, self.size + 3

    def ids(self, flat: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Id of every word, and the words as a dictionary array."""
        coded = flat.dictionary_encode()
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), self.other).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return known[codes] if len(codes) else np.empty(0, np.int64), coded

    def sequence(self, ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts one after the other, each between a start mark and an
        end token; the position of every word, and the text of every position."""
        size = per + 2
        doc = np.repeat(np.arange(len(per)), size)
        out = np.empty(len(doc), dtype=np.int64)
        ends = np.cumsum(size)
        out[ends - size], out[ends - 1] = self.start, self.end
        at = np.arange(len(ids)) + 2 * np.repeat(np.arange(len(per)), per) + 1
        out[at] = ids
        return out, at, doc


def _quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and the values they stand for (means of equal shares)."""
    if not len(logs):
        return np.empty(0, np.uint8), np.zeros(1)
    edges = np.unique(np.quantile(logs, np.linspace(0, 1, 257)[1:-1]))
    code = np.searchsorted(edges, logs, side="right")
    n = np.maximum(1, np.bincount(code, minlength=len(edges) + 1))
    return code.astype(np.uint8), np.bincount(code, logs, len(edges) + 1) / n


class Trie:
    """Three levels; see the module's docstring.  ``p1`` and ``back1`` are by
    id; ``words`` keeps ``context * width + id``, ``ranks`` keeps ``parent *
    reach + rank``."""

    def __init__(self, arrays: list[np.ndarray]):
        (self.width, self.reach), self.p1, self.back1 = (int(x) for x in arrays[0]), arrays[1], arrays[2]
        self.words, self.code2, self.mean2, self.bcode2, self.bmean2 = EliasFano.of(arrays[3:6]), *arrays[6:10]
        self.pointers = EliasFano.of(arrays[10:13])
        self.ranks, self.code3, self.mean3 = EliasFano.of(arrays[13:16]), *arrays[16:18]
        self.first = self.pointers.get(np.arange(self.pointers.n))

    @staticmethod
    def build(width: int, p1: np.ndarray, back1: np.ndarray, key2: np.ndarray, p2: np.ndarray, back2: np.ndarray,
              key3: np.ndarray, p3: np.ndarray, reach: int) -> bytes:
        starts = np.searchsorted(key2, np.arange(width + 1) * width)
        code2, mean2 = _quantise(p2)
        bcode2, bmean2 = _quantise(back2)
        code3, mean3 = _quantise(p3)
        return pack([np.array([width, reach], "<i8"), p1, back1, *EliasFano.encode(key2).arrays(), code2, mean2, bcode2, bmean2,
                     *EliasFano.encode(starts).arrays(), *EliasFano.encode(key3).arrays(), code3, mean3])

    @classmethod
    def open(cls, buffer) -> Trie:
        return cls(unpack(buffer))

    def _unique(self, sequence: EliasFano, keys: np.ndarray) -> np.ndarray:
        u, back = np.unique(keys, return_inverse=True)
        return sequence.find(u)[back]

    def nodes(self, prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
        """Level-two node of each pair, or -1."""
        return self._unique(self.words, prev * self.width + cur)

    def leaf_keys(self, parent: np.ndarray, prev: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Level-three value of a successor under the node of its two-word
        context (its rank among the successors of ``prev``), -1 without one."""
        return np.where((parent >= 0) & (node >= 0), parent * self.reach + node - self.first[prev], -1)

    def logs(self, seq: np.ndarray) -> np.ndarray:
        """log10 P of every position of a sequence of ids given the two before
        it; a start mark begins anew and has 0."""
        cur, prev = seq[1:], seq[:-1]
        node = np.where(cur < self.width - 1, self.nodes(prev, cur), -1)
        parent = np.concatenate([[-1], node[:-1]]) if len(node) else node
        parent = np.where(prev == self.width - 1, -1, parent)
        leaf = self._unique(self.ranks, self.leaf_keys(parent, prev, node))
        low = np.where(node >= 0, self.mean2[self.code2[node]] if len(self.code2) else 0.0, self.back1[prev] + self.p1[np.minimum(cur, self.width - 2)])
        back = np.where(parent >= 0, self.bmean2[self.bcode2[parent]] if len(self.bcode2) else 0.0, 0.0)
        out = np.where(leaf >= 0, self.mean3[self.code3[leaf]] if len(self.code3) else 0.0, back + low)
        return np.concatenate([[0.0], np.where(cur == self.width - 1, 0.0, out)])


def count_keys(texts: DataFrame, head: Head, trie: bytes | None = None) -> DataFrame:
    """(t) -> (key, n): bigrams as ``prev * width + id``, or, given the trie
    with its second level, the level-three values of the trigrams whose two
    bigrams it holds."""
    held = share(texts.sparkSession, (head, trie))

    def run(batches):
        words, buffer = opened(held)
        known = Trie.open(buffer) if buffer else None
        parts, size = [], 0

        def out():
            key, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int64), return_counts=True)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])
        for b in batches:
            flat, per = tokens(b.column("t"))
            seq, _, _ = words.sequence(words.ids(flat)[0], per)
            prev, cur = seq[:-1], seq[1:]
            keep = (cur != words.start) & (prev != words.other)
            if known is None:
                keys = (prev * words.width + cur)[keep]
            else:
                node = np.where(keep, known.nodes(prev, cur), -1)
                parent = np.where(prev == words.start, -1, np.concatenate([[-1], node[:-1]]) if len(node) else node)
                keys = known.leaf_keys(parent, prev, node)
                keys = keys[keys >= 0]
            parts.append(keys)
            size += len(keys)
            if size > CHUNK:
                yield out()
                size = 0
        yield out()
    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def kept(counts: DataFrame, max_entries: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and counts at or above the lowest threshold (2 at least) that
    holds at most ``max_entries``, in key order; and that threshold."""
    top = 100_000
    sizes = {r.c: r["count"] for r in counts.filter("n > 1").groupBy(F.least("n", F.lit(top)).alias("c")).count().collect()}
    total, least = 0, top + 1
    for c in sorted(sizes, reverse=True):
        if total + sizes[c] > max_entries:
            break
        total, least = total + sizes[c], c
    rows = counts.filter(F.col("n") >= least).orderBy("key").toArrow() if total else None
    if rows is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), least
    return rows.column("key").to_numpy(), rows.column("n").to_numpy(), least


def context_sums(counts: DataFrame, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For every context below ``most``: count of all its n-grams, and their
    number (dense arrays of the size of a level)."""
    rows = counts.groupBy(F.floor(F.col("key") / width).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).toArrow()
    n, k = np.zeros(most), np.zeros(most)
    n[rows.column("c").to_numpy()], k[rows.column("c").to_numpy()] = rows.column("n").to_numpy(), rows.column("k").to_numpy()
    return n, k


def smooth(keys: np.ndarray, n: np.ndarray, context: np.ndarray, sums: tuple[np.ndarray, np.ndarray], lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated Witten-Bell of the kept n-grams: their log10 probability
    and each context's log10 back-off weight.  ``lower`` is the probability of
    each n-gram's last word in the shorter context."""
    total, kinds = sums
    of = np.bincount(context, n, len(total))
    whole = np.maximum(total + kinds, 1e-9)
    spare = np.where(total > 0, (total + kinds - of) / whole, 1.0)
    p = n / whole[context] + spare[context] * lower
    return np.log10(p), np.log10(spare)


class Model:
    """Head words, the trie's buffer, and the exact unigram figures."""

    def __init__(self, head: Head, trie: bytes, base: np.ndarray, counts: np.ndarray, total: int, kinds: int, other_total: int, other_kinds: int):
        self.head, self.trie, self.base, self.counts = head, trie, base, counts
        self.total, self.kinds, self.other_total, self.other_kinds = total, kinds, other_total, other_kinds


def train(texts: DataFrame, vocabulary: DataFrame, head_size: int = HEAD, max_entries: int = MAX_ENTRIES, alpha: float = ALPHA) -> Model:
    """Model of the texts (t); ``vocabulary`` is their ``word_counts``."""
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    rows = vocabulary.filter("word <> ''").orderBy(F.desc("n"), "word").limit(head_size).collect()
    ends = vocabulary.filter("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    head = Head([r.word for r in rows])
    counts = np.array([r.n for r in rows] + [ends], dtype=np.int64)
    norm = total + alpha * (kinds + 1)
    share1 = (counts + alpha) / norm
    p1 = np.log10(np.append(share1, max(1e-12, 1 - share1.sum())))
    width = head.width
    empty = np.empty(0, np.int64)
    bigrams = materialize(count_keys(texts, head), "lm-bigrams")
    key2, n2, _ = kept(bigrams, max_entries)
    logp2, back1 = smooth(key2, n2, key2 // width, context_sums(bigrams, width, width), 10 ** p1[key2 % width])
    starts = np.searchsorted(key2, np.arange(width + 1) * width)
    reach = int(np.diff(starts).max(initial=1)) or 1
    key3, n3, back2, logp3 = empty, empty, np.zeros(len(key2)), empty
    if len(key2):
        trigrams = materialize(count_keys(texts, head, Trie.build(width, p1, back1, key2, logp2, back2, empty, empty, reach)), "lm-trigrams")
        key3, n3, _ = kept(trigrams, max_entries)
        parent = key3 // reach
        short = starts[key2[parent] % width] + key3 % reach      # the same last word after one word of context
        # occurrences of a context include those whose trigram was not countable
        seen = context_sums(trigrams, reach, len(key2))
        sums = (np.maximum(seen[0], n2), seen[1] + (n2 > seen[0]))
        logp3, back2 = smooth(key3, n3, parent, sums, 10 ** logp2[short])
    trie = Trie.build(width, p1, back1, key2, logp2, back2, key3, logp3, reach)
    return Model(head, trie, np.log10(share1), counts, int(total), int(kinds),
                 int(total - counts.sum()), int(max(0, kinds - len(rows) - (ends > 0))))


def score_heads(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, t) -> one row per document with its sums over head
    words and end token, and its other words with their counts."""
    held = share(docs.sparkSession, model)

    def run(batches):
        from pyspark import TaskContext
        m = opened(held)
        trie, head = Trie.open(m.trie), m.head
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            flat, per = tokens(b.column("t"))
            ids, coded = head.ids(flat)
            seq, at, doc = head.sequence(ids, per)
            logs = trie.logs(seq)
            real = (seq < head.other)
            n_docs = len(per)
            base = np.bincount(doc[real], m.base[seq[real]], n_docs)
            known = np.bincount(doc[real], m.counts[seq[real]] > 0, n_docs).astype(np.int64)
            whole = np.bincount(doc, logs, n_docs)
            tail = np.flatnonzero(ids == head.other)
            key, times = np.unique(doc[at[tail]] * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)[tail], return_counts=True)
            owner, word = np.divmod(key, max(1, len(coded.dictionary)))
            off = pa.array(np.searchsorted(owner, np.arange(n_docs + 1)).astype(np.int32))
            words = coded.dictionary.take(pa.array(word)).cast(pa.string())
            others = np.bincount(doc[at[tail]], minlength=n_docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(n_docs)), b.column("doc_id"), b.column("held_out"), pa.array(per + 1), pa.array(known), pa.array(base), pa.array(whole),
                 pa.array(others), pa.ListArray.from_arrays(off, words), pa.ListArray.from_arrays(off, pa.array(times, pa.int64()))],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "whole", "others", "words", "times"])
            row += n_docs
    return docs.select("doc_id", "held_out", "t").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, whole double, others long, words array<string>, times array<long>")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", head_size: int | None = None,
          max_entries: int | None = None, alpha: float = ALPHA) -> DataFrame:
    """One row per document: doc_id, held_out (not in training), n_tokens,
    n_known, train_tokens, base_score, score (log10 probabilities).  The
    model is whole (``lm_shards``) unless ``head_size`` or ``max_entries`` asks
    for the bounded trie."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~training).alias("held_out"), text_of(text_col).alias("t"))
    texts = src.filter(~F.col("held_out")).select("t")
    vocabulary = materialize(word_counts(texts), "lm-words")
    if head_size is None and max_entries is None:
        whole = lm_shards.train(texts, vocabulary)
        return lm_shards.score_texts(src, whole, alpha).select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(whole.total).cast("long").alias("train_tokens"), "base_score", "score")
    m = train(texts, vocabulary, head_size or HEAD, max_entries or MAX_ENTRIES, alpha)
    rows = materialize(score_heads(src, m), "lm-docs")
    each = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    found = (each.join(vocabulary.filter("word <> ''"), "word", "left").groupBy("row")
             .agg(F.sum(F.col("times") * F.log10(n + alpha)).alias("logs"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"))
             .withColumnRenamed("row", "tail_row"))
    norm, other_norm = (float(np.log10(x + alpha * (k + 1))) for x, k in ((m.total, m.kinds), (m.other_total, m.other_kinds)))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("words", "times").join(found, F.col("row") == F.col("tail_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(m.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("others") * norm).alias("base_score"),
        (F.col("whole") + logs - F.col("others") * other_norm).alias("score"))
