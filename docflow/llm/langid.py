"""Language identification, word first.

Known words are scored by their log frequency in each language.  An unseen
word falls back to its character n-grams, longest first: the longest length
with a known n-gram decides, and the word gets the mean log frequency of its
known n-grams of that length.  A text's score is the sum over its words.

The classifier is fitted on about ``per_lang`` labelled texts of each language
(those with the lowest hashes of their ids, by a threshold that needs no
ranking); every word and every n-gram of these counts, also those seen once.
The sample bounds what is sent to the tasks.  Word and n-gram counts are Spark
aggregations, and scoring reads every whole text in Arrow batches: the
different words of a batch are looked up once, those that are not known
through their n-grams, and the sums are array operations.

Defined cases: ``und`` with score 0 for a null text, a text without letters,
or when nothing could be learned; languages that tie go to the first in
code-point order; rows with a null language are not learned from; a text of
any length counts whole; repeated rows are scored alike; an empty table gives
an empty result; input columns other than id, text and language are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize, opened, share

PER_LANG = 5000
LENGTHS = (4, 3, 2, 1)
NOT_LETTERS = r"\P{L}+"
UNKNOWN = "und"


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased runs of letters of all texts, and the text of each."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), NOT_LETTERS)
    flat, owner = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full).dictionary_encode(), owner.filter(full).to_numpy(zero_copy_only=False)


def word_grams(words: list[str], n: int) -> tuple[list[str], np.ndarray]:
    """The n-grams of all words (with marks at both ends), and the word of each."""
    marked = [f"\x02{w}\x03" for w in words] if n > 1 else words
    grams = [s[i:i + n] for s in marked for i in range(len(s) - n + 1)]
    return grams, np.repeat(np.arange(len(words)), [max(0, len(s) - n + 1) for s in marked])


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, word, n), pre-aggregated in each batch."""
    def run(batches):
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            coded, owner = words(b.column("text"))
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            lang = pc.fill_null(langs.indices, len(langs.dictionary)).to_numpy(zero_copy_only=False)[owner]
            keys, n = np.unique(lang * max(1, len(coded.dictionary)) + code, return_counts=True)
            at, word = np.divmod(keys, max(1, len(coded.dictionary)))
            names = pa.concat_arrays([langs.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), coded.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])
    return texts.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Table:
    """Log frequencies of keys, one column a language."""

    def __init__(self, keys: pa.Array, logs: np.ndarray):
        self.keys, self.logs = keys, logs

    @classmethod
    def of(cls, counts: DataFrame, langs: list[str]) -> Table:
        """From (lang, key, n), with half a count where a language lacks the key."""
        got = counts.toArrow()
        coded = got.column("key").combine_chunks().dictionary_encode()
        n = np.zeros((len(coded.dictionary), len(langs)))
        lang = pc.index_in(got.column("lang"), value_set=pa.array(langs, pa.string())).to_numpy()
        n[coded.indices.to_numpy(zero_copy_only=False), lang] = got.column("n").to_numpy()
        return cls(coded.dictionary.cast(pa.large_string()), np.log10((n + 0.5) / (n.sum(axis=0) + 0.5 * (len(n) + 1))))

    def find(self, keys: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(keys.cast(pa.large_string()), value_set=self.keys), -1).to_numpy(zero_copy_only=False)


class Model:
    """The tables of words and of n-grams by length."""

    def __init__(self, langs: list[str], words: Table, grams: dict[int, Table]):
        self.langs, self.words, self.grams = langs, words, grams

    def vectors(self, words: pa.Array) -> np.ndarray:
        """Log frequencies of distinct words, a row each; zeros if nothing of
        a word is known."""
        at = self.words.find(words)
        out = np.zeros((len(words), len(self.langs)))
        out[at >= 0] = self.words.logs[at[at >= 0]]
        rest = np.flatnonzero(at < 0)
        names = words.take(pa.array(rest)).to_pylist()
        for n in LENGTHS:
            if not len(rest):
                break
            grams, owner = word_grams(names, n)
            found = self.grams[n].find(pa.array(grams, pa.large_string()))
            owner, found = owner[found >= 0], found[found >= 0]
            many = np.bincount(owner, minlength=len(rest))
            for l in range(len(self.langs)):
                sums = np.bincount(owner, self.grams[n].logs[found, l], len(rest))
                out[rest[many > 0], l] = sums[many > 0] / many[many > 0]
            names = [w for w, k in zip(names, many) if not k]
            rest = rest[many == 0]
        return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Model:
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    # one row a language, written so that its size is known to the join
    per = materialize(rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "langid-languages")
    # hashes below the share of a language that makes per_lang texts
    low = F.shiftrightunsigned(F.xxhash64("id", "text"), 11) / float(1 << 53)
    chosen = rows.join(per, F.col("lang") == F.col("of")).filter(low * F.col("n") <= per_lang)
    counts = materialize(count_words(chosen), "langid-words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    grams = {}
    for n in LENGTHS:
        s = F.concat(F.lit("\x02"), "word", F.lit("\x03")) if n > 1 else F.col("word")
        at = F.explode(F.when(F.length(s) >= n, F.sequence(F.lit(1), F.length(s) - n + 1)))
        each = counts.select("lang", "n", s.alias("s"), at.alias("i")).select("lang", F.expr(f"substring(s, i, {n})").alias("key"), "n")
        grams[n] = Table.of(each.groupBy("lang", "key").agg(F.sum("n").alias("n")), langs)
    return Model(langs, Table.of(counts.withColumnRenamed("word", "key"), langs), grams)


def said(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the share of the best language when the
    text's mean log frequencies are weighed over at most 20 words."""
    coded, owner = words(texts)
    many = np.bincount(owner, minlength=len(texts))
    if not model.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = model.vectors(coded.dictionary)
    code = coded.indices.to_numpy(zero_copy_only=False)
    total = np.stack([np.bincount(owner, rows[code, l], len(texts)) for l in range(len(model.langs))], axis=1)
    best = total.argmax(axis=1)
    p = 10.0 ** ((total - total.max(axis=1, keepdims=True)) * (np.minimum(many, 20) / np.maximum(many, 1))[:, None])
    score = np.where(many > 0, p.max(axis=1) / p.sum(axis=1), 0.0)
    return [model.langs[b] if m else UNKNOWN for b, m in zip(best, many)], score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    held = share(docs.sparkSession, model)

    def run(batches):
        model = opened(held)
        for b in batches:
            lang, score = said(model, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
