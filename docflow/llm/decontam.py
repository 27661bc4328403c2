"""Benchmark decontamination with a distributed positional inverted index.

The index is a table in the shared folder.  Each of its rows covers a block
of documents: the block's terms and, for each, its postings (ascending token
positions, stored as differences), plus where every document ends.  It serves
any number of benchmark sets.

A search cuts the benchmark's items into windows (equal windows once).  Each
window is filed under the term that occurs in the fewest of them; a block
looks up only the windows filed under terms that it holds, keeps those whose
terms it all holds, and intersects the terms' position lists, each shifted by
the term's place in the window, from the rarest on.  What is left are exact phrase occurrences.  With ``slop`` above
zero a term may stand that many positions off its place, and the occurrences
are proximity matches.  No text or posting is shuffled: a block is searched
where it is read.

Items reach the tasks in passes of about ``words_per_pass`` words, which bounds
what is sent; a document's hits are joined as spans by a running maximum of
their ends, so the work is linear in them.

Defined cases: null texts have no words; an item without words matches
nothing; an item that repeats counts once for each item id (null: empty); an
item shorter than a window is one window; a match never crosses a document's
end; empty tables give empty or clean results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize, opened, prepare, share, text_of

WINDOW = 10
BLOCK_BYTES = 2 << 20
WORDS_PER_PASS = 500_000
ROW_GROUP = 4 << 20

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of bytes above ASCII."""
    return text.translate(_KEEP).split()


INDEX = ("block long, doc_id array<long>, text_hash array<long>, ends array<long>, "
         "terms array<string>, counts array<int>, steps array<int>")


def index_block(block: int, doc_ids: list, hashes: list, docs: list[list[bytes]]) -> list:
    """One row of the index."""
    coded = pa.array([w for d in docs for w in d], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(coded.dictionary)) if len(codes) else np.zeros(0, np.int64)
    steps = np.diff(order, prepend=0)
    starts = np.cumsum(counts) - counts
    steps[starts] = order[starts]
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return [pa.array([block], pa.int64()), one(doc_ids, pa.int64()), one(hashes, pa.int64()), one(np.cumsum([len(d) for d in docs]).astype(np.int64), pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string())),
            one(counts.astype(np.int32), pa.int32()), one(steps.astype(np.int32), pa.int32())]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Index table of ``docs``, written to the shared folder."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        held, size = ([], [], []), 0
        for b in batches:
            for i, h, t in zip(b.column("id").to_pylist(), b.column("h").to_pylist(), b.column("t").cast(pa.binary()).to_pylist()):
                if held[0] and size + len(t) > block_bytes:
                    yield pa.RecordBatch.from_arrays(index_block(block, *held), names=names)
                    held, size, block = ([], [], []), 0, block + 1
                for part, x in zip(held, (i, h, words(t))):
                    part.append(x)
                size += len(t)
        if held[0]:
            yield pa.RecordBatch.from_arrays(index_block(block, *held), names=names)
    text = text_of(text_col)
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))
    return materialize(rows.mapInArrow(run, INDEX), "decontam-index", ROW_GROUP)


class Windows:
    """Distinct windows of some items: term numbers (padded with -1) and the
    items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        found: dict[tuple, set] = {}
        for item, ws in items:
            for i in range(max(1, len(ws) - window + 1) if ws else 0):
                found.setdefault(tuple(ws[i:i + window]), set()).add(item)
        vocab = {w: k for k, w in enumerate(sorted({w for key in found for w in key}))}
        self.vocab = pa.array(list(vocab), pa.binary()).cast(pa.string())
        self.terms = np.full((len(found), window), -1, dtype=np.int64)
        self.items = [sorted(x) for x in found.values()]
        for r, key in enumerate(found):
            self.terms[r, :len(key)] = [vocab[w] for w in key]
        self.size = (self.terms >= 0).sum(axis=1)
        # windows by the term that the fewest of them hold
        share = np.bincount(self.terms[self.terms >= 0], minlength=len(vocab) + 1)
        share[-1] = len(found) * window + 1                 # the padding (-1)
        key = self.terms[np.arange(len(found)), share[self.terms].argmin(axis=1)] if len(found) else np.zeros(0, np.int64)
        self.by_term = np.argsort(key, kind="stable")
        self.first = np.searchsorted(key[self.by_term], np.arange(len(vocab) + 1))

    def filed_under(self, terms: np.ndarray) -> np.ndarray:
        """The windows filed under any of ``terms``."""
        n = self.first[terms + 1] - self.first[terms]
        ends = np.cumsum(n)
        return self.by_term[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(self.first[terms], n)]


def intersect(lists: list[np.ndarray], slop: int = 0) -> np.ndarray:
    """Starts at which every list (positions of the window's i-th term) has a
    position within ``slop`` of start + i; the rarest list first."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    start = lists[order[0]] - order[0]
    if slop:
        start = np.unique((start[:, None] + np.arange(-slop, slop + 1)).ravel())
    for i in order[1:]:
        if not len(start):
            break
        at = np.searchsorted(lists[i], start + i - slop)
        ok = at < len(lists[i])
        ok[ok] = lists[i][at[ok]] <= start[ok] + i + slop
        start = start[ok]
    return start


def search_block(terms: pa.Array, counts: np.ndarray, steps: np.ndarray, ends: np.ndarray, w: Windows, slop: int = 0) -> tuple[np.ndarray, ...]:
    """Matches as arrays: the document's place in the block, first, after, window."""
    none = np.zeros(0, dtype=np.int64)
    if not len(ends) or not len(w.size):
        return none, none, none, none
    place = pc.fill_null(pc.index_in(w.vocab, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    near = w.filed_under(np.flatnonzero(place >= 0))
    here = np.where(w.terms[near] >= 0, place[w.terms[near]], 0)
    full = ((here >= 0) | (w.terms[near] < 0)).all(axis=1)
    first = np.cumsum(counts) - counts
    open_: dict[int, np.ndarray] = {}

    def postings(t):
        if t not in open_:
            open_[t] = np.cumsum(steps[first[t]:first[t] + counts[t]], dtype=np.int64)
        return open_[t]
    starts, windows = [none], [none]
    for r, row in zip(near[full], here[full]):
        start = intersect([postings(t) for t in row[:w.size[r]]], slop)
        starts.append(start[(start >= 0) & (start < ends[-1])])
        windows.append(np.full(len(starts[-1]), r))
    start, window = np.concatenate(starts), np.concatenate(windows)
    doc = np.searchsorted(ends, start, side="right")
    after = start + w.size[window]
    whole = after <= ends[doc]
    return doc[whole], start[whole], after[whole], window[whole]


def join_spans(doc: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans that touch or overlap within a document become one, in order."""
    if not len(doc):
        return doc, first, after
    order = np.lexsort((first, doc))
    doc, first, after = doc[order], first[order], after[order]
    reach = np.maximum.accumulate(after + doc * (after.max() + 1))      # documents one after another
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | ((first + doc * (after.max() + 1))[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return doc[at], first[at], np.maximum.reduceat(after, at)


HITS = "block long, slot long, spans array<struct<first:long,after:long>>, items array<string>"


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))


def span_lists(doc: np.ndarray, first: np.ndarray, after: np.ndarray, docs: np.ndarray) -> pa.Array:
    """The spans of each of ``docs``, in a list."""
    both = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(after, pa.int64())], names=["first", "after"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, [*docs, np.iinfo(np.int64).max]), pa.int32()), both).cast(SPANS)


def search(index: DataFrame, items: list[tuple[str, list[bytes]]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Hits of one pass: a row for each document with any, spans joined."""
    held = share(index.sparkSession, Windows(items, window))

    def run(batches):
        w = opened(held)
        for b in batches:
            for k in range(b.num_rows):
                part = lambda name: b.column(name)[k].values  # noqa: B023, E731
                number = lambda name: part(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                doc, first, after, r = search_block(part("terms"), number("counts"), number("steps"), number("ends"), w, slop)
                spans = join_spans(doc, first, after)
                found: dict[int, set] = {}
                for d, x in np.unique(np.stack([doc, r]), axis=1).T.tolist():
                    found.setdefault(d, set()).update(w.items[x])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("block")[k].as_py()] * len(found), pa.int64()), pa.array(list(found), pa.int64()),
                     span_lists(*spans, np.array(list(found), dtype=np.int64)), pa.array([sorted(x) for x in found.values()], pa.list_(pa.string()))],
                    names=["block", "slot", "spans", "items"])
    return index.select("block", "ends", "terms", "counts", "steps").mapInArrow(run, HITS)


def joined(batches):
    """Arrow step: the spans of each row, which come from several passes, joined."""
    for b in batches:
        lists = b.column("spans")
        row = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        flat = lists.flatten()
        spans = join_spans(row, *[flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        yield b.set_column(b.schema.get_field_index("spans"), "spans", span_lists(*spans, np.arange(b.num_rows)))


def passes(items: DataFrame, id_col: str, text_col: str, words_per_pass: int):
    """Lists of (item id, words), together all items, each of bounded size."""
    text = text_of(text_col)
    base = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), text.cast("binary").alias("t"))
    total = base.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, -(-total // (6 * words_per_pass)))
    for k in range(n):
        yield [(r.item, words(bytes(r.t))) for r in base.filter(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == k).collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, slop: int = 0, words_per_pass: int = WORDS_PER_PASS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, spans (joined,
    from 0 in the document), items (ids of the matching items)."""
    index = build_index(docs, id_col, text_col, block_bytes)
    hits = None
    for items in passes(benchmark, item_col, item_text_col, words_per_pass):
        found = search(index, items, window, slop)
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("block", "slot").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                             F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).mapInArrow(joined, HITS)
    each = index.select("block", F.posexplode(F.arrays_zip("doc_id", "text_hash", "ends")).alias("slot", "d"),
                        "ends").select("block", F.col("slot").cast("long").alias("slot"), "d.doc_id", "d.text_hash", F.col("d.ends").alias("end"),
                                       F.when(F.col("slot") > 0, F.element_at("ends", F.col("slot"))).otherwise(0).alias("begin"))
    out = each.join(hits, ["block", "slot"], "left")
    none = F.array().cast("array<struct<first:long,after:long>>")
    spans = F.coalesce(F.transform("spans", lambda s: F.struct((s["first"] - F.col("begin")).alias("first"), (s["after"] - F.col("begin")).alias("after"))), none)
    return out.select("doc_id", "text_hash", (F.col("end") - F.col("begin")).alias("n_words"), spans.alias("spans"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items")) \
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["after"] - s["first"]))
