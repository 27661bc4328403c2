"""Many terms in one pass over a text.

The terms form an Aho-Corasick automaton held in a few arrays: a sorted array
of (node, character) keys, in which the child's number is the key's place, the
failure link of each node, its term, and the next shorter suffix that ends a
term.  It is built level by level, for all terms at once.

A text is read once, whatever the number of terms.  The texts of an Arrow
batch are cut into pieces that overlap by the longest term, and all pieces
advance together, one character a step, so a step is a handful of array
operations on thousands of pieces.

A dictionary of any size is taken in blocks of at most ``BLOCK_CHARS``
characters of distinct terms (about a million terms; some 20 bytes a
character in each worker).  One block, the usual case, is one pass.  Each
further block is one more pass that yields narrow rows (row number and hits).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from docflow.operators.ranking import written

BLOCK_CHARS = 8_000_000
BLOCK_ROWS = 2_000_000
PIECE = 256                 # characters a piece advances, besides its overlap
TABLE = 8_000_000           # entries a full transition table may have
_SHIFT = 21                 # bits of a code point


def owner(long: DataFrame) -> StructType:
    """The type of a hit: a row of the dictionary."""
    return StructType([StructField("term_id", long.schema["term_id"].dataType), StructField("lang", StringType()), StructField("term", StringType())])


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)


@dataclass
class Automaton:
    """Node 0 is the root; child ``i + 1`` belongs to ``keys[i]``."""

    keys: np.ndarray        # parent << 21 | character, ascending
    fail: np.ndarray
    term: np.ndarray        # number of the term that ends here, or -1
    link: np.ndarray        # next suffix that ends a term, or 0
    levels: list[int]       # first node of each depth from 1 on, and the end

    @property
    def longest(self) -> int:
        return len(self.levels) - 1

    @classmethod
    def build(cls, terms: list[str]) -> Automaton:
        """``terms``: distinct and not empty."""
        codes = code_points(terms).astype(np.int64)
        sizes = np.array([len(t) for t in terms], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        node, live, levels, count = np.zeros(len(terms), dtype=np.int64), np.arange(len(terms)), [], 1
        while len(live):
            key, place = np.unique(node[live] << _SHIFT | codes[starts[live] + len(levels)], return_inverse=True)
            node[live] = count + place
            levels.append(key)
            count += len(key)
            live = live[sizes[live] > len(levels)]
        out = cls(np.concatenate([np.zeros(0, dtype=np.int64), *levels]), np.zeros(count, dtype=np.int32),
                  np.full(count, -1, dtype=np.int32), np.zeros(count, dtype=np.int32), [1])
        out.term[node] = np.arange(len(terms))
        for depth, key in enumerate(levels):
            here = np.arange(out.levels[-1], out.levels[-1] + len(key))
            if depth:
                out.fail[here] = out.step(out.fail[key >> _SHIFT], key & ((1 << _SHIFT) - 1))
            back = out.fail[here]
            out.link[here] = np.where(out.term[back] >= 0, back, out.link[back])
            out.levels.append(out.levels[-1] + len(key))
        return out

    def table(self) -> tuple[np.ndarray, np.ndarray] | None:
        """(class of each character, node after each node and class), where
        that fits: one look-up then takes the place of a search for the child
        and of the failure links.  Class 0 stands for all other characters."""
        char = self.keys & ((1 << _SHIFT) - 1)
        known = np.unique(char)
        if len(self.fail) * (len(known) + 1) > TABLE:
            return None
        classes = np.zeros(1 << _SHIFT, dtype=np.int64)
        classes[known] = np.arange(1, len(known) + 1)
        after = np.zeros((len(self.fail), len(known) + 1), dtype=np.int64)
        parent, kid = self.keys >> _SHIFT, np.arange(1, len(self.fail))
        for lo, hi in zip([0, *self.levels[:-1]], self.levels, strict=True):
            if lo:
                after[lo:hi] = after[self.fail[lo:hi]]
            a, b = np.searchsorted(parent, [lo, hi])
            after[parent[a:b], classes[char[a:b]]] = kid[a:b]
        return classes, after

    def child(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) << _SHIFT | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at + 1, 0)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The node after each ``char``: the child, else the child of the
        longest proper suffix that has one."""
        out = self.child(node, char)
        rest = np.nonzero((out == 0) & (node != 0))[0]
        node = node[rest]
        while len(rest):
            node = self.fail[node]
            got = self.child(node, char[rest])
            out[rest] = got
            open_ = (got == 0) & (node != 0)
            rest, node = rest[open_], node[open_]
        return out

    def search(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text number, term number), sorted."""
        codes = code_points(texts).astype(np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        n_pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(texts)), n_pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        begin = (ends - sizes)[text] + nth * PIECE
        start = np.maximum(begin - (self.longest - 1), (ends - sizes)[text])
        length = np.minimum(begin + PIECE, ends[text]) - start
        order = np.argsort(-length, kind="stable")
        text, start, length = text[order], start[order], length[order]
        state, found = np.zeros(len(text), dtype=np.int64), [np.zeros(0, dtype=np.int64)]
        ends_term = (self.term >= 0) | (self.link > 0)
        quick = self.quick = getattr(self, "quick", None) or self.table()
        if quick:
            codes, after, width = quick[0][codes], quick[1].ravel(), quick[1].shape[1]
        for t in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -t, side="left"))     # pieces longer than t come first
            char = codes[start[:live] + t]
            state = after[state[:live] * width + char] if quick else self.step(state[:live], char)
            hit = np.nonzero(ends_term[state])[0]
            if len(hit):
                found.append(np.unique(text[hit] * len(self.term) + state[hit]))
        pairs = np.unique(np.concatenate(found))
        text, node, out = pairs // len(self.term), pairs % len(self.term), [np.zeros((2, 0), dtype=np.int64)]
        while len(node):
            ends_here = self.term[node] >= 0
            out.append(np.stack([text[ends_here], self.term[node[ends_here]]]))
            node = self.link[node]
            text, node = text[node > 0], node[node > 0]
        both = np.unique(np.concatenate(out, axis=1), axis=1)
        return both[0], both[1]


@dataclass
class Block:
    """An automaton and, for each of its terms, the rows that have it."""

    automaton: Automaton
    terms: pa.Array
    first: np.ndarray       # of each term in ids and langs, and their end
    ids: pa.Array
    langs: pa.Array

    def found(self, texts: pa.Array) -> pa.ListArray:
        """For each text the rows of the block whose term is in it."""
        text, term = self.automaton.search(pc.fill_null(texts, "").to_pylist())
        n = self.first[term + 1] - self.first[term]
        text, term, ends = np.repeat(text, n), np.repeat(term, n), np.cumsum(n)
        row = np.arange(len(term)) - np.repeat(ends - n, n) + self.first[term]
        offsets = np.searchsorted(text, np.arange(len(texts) + 1))
        values = pa.StructArray.from_arrays([self.ids.take(pa.array(row)), self.langs.take(pa.array(row)), self.terms.take(pa.array(term))],
                                            names=["term_id", "lang", "term"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def blocks(long: DataFrame, block_chars: int | None = None) -> Iterator[Block]:
    """The rows (term_id, lang, term) with a term, in blocks of bounded size;
    the driver holds one at a time."""
    most = block_chars or BLOCK_CHARS
    id_type = pa.int64() if isinstance(long.schema["term_id"].dataType, LongType) else pa.int32()
    terms, first, ids, langs, chars = [], [], [], [], 0

    def made() -> Block:
        return Block(Automaton.build(terms), pa.array(terms, pa.string()), np.array([*first, len(ids)]), pa.array(ids, id_type),
                     pa.array(langs, pa.string()))
    rows = long.select("term_id", "lang", "term").filter("term <> ''").distinct()
    for r in rows.orderBy("term", "term_id", "lang").toLocalIterator():
        if not terms or terms[-1] != r.term:
            if chars >= most:
                yield made()
                terms, first, ids, langs, chars = [], [], [], [], 0
            terms.append(r.term)
            first.append(len(ids))
            chars += len(r.term)
        ids.append(r.term_id)
        langs.append(r.lang)
        if len(ids) >= BLOCK_ROWS:
            yield made()
            terms, first, ids, langs, chars = [], [], [], [], 0
    if terms:
        yield made()


def add_found(held, text: str, out: str, narrow: bool = False):
    """Arrow step: the column ``out`` with the hits of each text (``narrow``:
    the row number and the hits, for texts that have any)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle
        block = pickle.loads(held.value)
        for b in batches:
            texts = b.column(text)
            size = max(1, int(len(texts) * min(1.0, (8 << 20) / max(1, texts.nbytes))))   # some 8 MB of text at a time
            for at in range(0, len(texts), size):
                part = b.slice(at, size)
                hits = block.found(part.column(text))
                if not narrow:
                    yield pa.RecordBatch.from_arrays([*part.columns, hits], names=[*part.schema.names, out])
                    continue
                some = pc.greater(pc.list_value_length(hits), 0)
                yield pa.RecordBatch.from_arrays([part.column("__row"), hits], names=["__row", out]).filter(some)
    return run


def search_terms(df: DataFrame, text: str, long: DataFrame, out: str = "kw_found", block_chars: int | None = None) -> DataFrame:
    """``df`` with ``out``: the rows (term_id, lang, term) of ``long`` whose
    term is a part of ``text``, sorted.  A null text has none, and empty or
    null terms are found nowhere."""
    from pyspark import cloudpickle
    sc, kind = df.sparkSession.sparkContext, ArrayType(owner(long))
    # texts as plain strings: Arrow gives them 32-bit offsets within a batch of bounded bytes
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    held = [sc.broadcast(cloudpickle.dumps(b)) for b in blocks(long, block_chars)]
    none = F.array().cast(kind)
    if not held:
        return df.withColumn(out, none)
    if len(held) == 1:
        schema = StructType([*[f for f in df.schema if f.name != out], StructField(out, kind)])
        return df.drop(out).mapInArrow(add_found(held[0], text, out), schema).withColumn(out, F.sort_array(out))
    # several blocks: texts are numbered in one table, hits are joined to it
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()), "searched")
    narrow = StructType([StructField("__row", LongType()), StructField(out, kind)])
    hits = None
    for b in held:
        got = rows.select("__row", text).mapInArrow(add_found(b, text, out, narrow=True), narrow)
        hits = got if hits is None else hits.unionByName(got)
    hits = written(hits.groupBy("__row").agg(F.sort_array(F.flatten(F.collect_list(out))).alias(out)), "found")
    return rows.drop(out).join(hits, "__row", "left").withColumn(out, F.coalesce(out, none)).drop("__row")
