"""The whole trigram model as Elias-Fano tries in shards: every word, bigram
and trigram of the training texts.

Words have ids by the rank of their 62-bit hash (checked to be distinct).  A
two-word context (a, b) belongs to one shard, by a hash of both, with all that
follows it; so shards are of like size whatever the texts hold, their number
follows the training tokens, and a frequent word is spread over all of them.

A shard is a trie of three levels (``Trie``).  Its heads are first words, its
nodes the second words after each head, its leaves the third words after each
node.  Children stand in the order of their parents, and each is stored
relative to its context: the words after a context ascend, and each context
begins where the one before it ended, so that a level is one ascending
Elias-Fano sequence.  Monotone pointers, Elias-Fano coded, say where the values
of each context begin.  A query takes a context's base and end from them and
searches the successor base + word; a value from the end on belongs to another
context.

Probabilities are interpolated Witten-Bell over complete counts, down to a
unigram with ``alpha`` added for each word and for one unseen word.  A leaf
holds the code of its smoothed share n / (N + K) of the context, a node that
of its context's back-off weight K / (N + K) and of its own count, from which
the share of a bigram follows.  Codes have 8 bits and stand for the mean of
one of 256 equal steps of the logarithm, so a value is off by at most 1 / 256
of the range of its level's logarithms, mostly by far less.

Tasks write the shards to the shared folder of ``spark.checkpoint.dir`` and the
scoring tasks map the files into memory; neither the driver nor a broadcast
holds any of the model.  n-grams travel packed, a row for each shard and
chunk, in context order and summed within a chunk; bigrams need no exchange of
their own, as a shard has all of a context.

Defined cases: a null text is empty and has its end token; repeated rows are
scored each; a text of any length is scored whole; without training texts
every token is unknown; an empty table gives no row; null ids are kept.
"""

from __future__ import annotations

import mmap
import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.elias_fano import EliasFano, pack, unpack
from docflow.session import scratch_path

U64, BITS, ID_BITS = np.uint64, 62, 31
MASK = U64((1 << BITS) - 1)
SHARD = 1_500_000      # training tokens for each shard, at most
BLOCK = 1 << 20        # ids in a file of successor counts
CHUNK = 2_000_000      # positions counted at a time
PIECE = 8 << 20        # bytes of text scored at a time (a text is not cut)
OPEN = 64              # shards of a level that a task keeps open


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 62-bit integers."""
    x = x.astype(U64)
    for by, shift in ((0x1E3779B97F4A7C15, 31), (0x3F58476D1CE4E5B9, 29), (0x14D049BB133111EB, 32)):
        x = (x * U64(by)) & MASK
        x ^= x >> U64(shift)
    return x.astype(np.int64)


def shard_of(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The shard of each context (a, b)."""
    return mix((a.astype(U64) << U64(ID_BITS)) | b.astype(U64)) >> (BITS - bits)


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where, in sorted columns, a new combination begins."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def by_shard(shard: np.ndarray) -> np.ndarray:
    """A stable order by shard."""
    return np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")


def hashes(words: pa.Array, salt: int) -> np.ndarray:
    """62-bit hashes: the bytes of a word are the digits of a number to a base
    that the salt picks, modulo 2 ** 64, and its bits are then scrambled."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    size, out = np.diff(ends), np.zeros(len(words), dtype=U64)
    if not size.sum():
        return mix(out & MASK)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(U64) + U64(1)
    base = U64((0x9E3779B97F4A7C15 * (2 * salt + 1) | 1) & (2**64 - 1))
    power = np.cumprod(np.full(size.max(), base, dtype=U64))
    first = ends[:-1] - ends[0]
    digit = np.arange(len(data)) - np.repeat(first, size)
    full = size > 0
    out[full] = np.add.reduceat(data * power[digit], first[full])
    out ^= out >> U64(32)
    return mix(out & MASK)


def shard_bits(items: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, items) / SHARD))))


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes of the numbers by significance, for blocks that compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).ravel()


def _numbers(raw: np.ndarray, n: int) -> np.ndarray:
    size = len(raw) // n if n else 1
    return np.ascontiguousarray(raw.reshape(size, n).T).view(f"<u{size}").ravel().astype(np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def packed(part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """(shard, data): a row for each value of ``part``, which is in order, as
    is the first column within it; that one is kept as steps."""
    shards, at = np.unique(part, return_index=True)
    data = []
    for s, e in zip(at, [*at[1:], len(part)]):
        first = columns[0][s:e].astype(np.int64)
        steps = np.diff(first, prepend=first[0])
        data.append(pack([np.array([e - s, first[0]], "<i8"), *[_planes(_narrow(c)) for c in (steps, *[c[s:e] for c in columns[1:]])]]))
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(data, pa.binary())], names=["shard", "data"])


def unpacked(batches, width: int) -> list[np.ndarray]:
    """The columns of all rows, one after the other."""
    parts = [[] for _ in range(width)]
    for b in batches:
        for raw in b.column("data"):
            (n, first), *columns = unpack(raw.as_py())
            columns = [_numbers(c, int(n)) for c in columns]
            for into, c in zip(parts, [first + np.cumsum(columns[0]), *columns[1:]]):
                into.append(c)
    return [np.concatenate(p) if p else np.empty(0, np.int64) for p in parts]


def codes8(x: np.ndarray) -> list[np.ndarray]:
    """8-bit codes of equal steps between the least and the greatest value,
    and the mean of each."""
    if not len(x):
        return [np.zeros(0, np.uint8), np.zeros(1)]
    code = np.minimum((x - x.min()) * (256 / (np.ptp(x) or 1.0)), 255).astype(np.uint8)
    n = np.bincount(code, minlength=256)
    return [code, np.bincount(code, x, 256) / np.maximum(1, n)]


def relative(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending words of each context (which begin at ``first``) as one
    ascending sequence, and where in it each context begins: after the last
    value of the one before it.  The last entry is the end."""
    last = words[np.append(first[1:], len(words)) - 1] + 1
    base = np.cumsum(last) - last
    return words + np.repeat(base, np.diff(np.append(first, len(words)))), np.append(base, base[-1] + last[-1])


class Trie:
    """One shard; see the module's docstring."""

    def __init__(self, arrays: list[np.ndarray]):
        self.heads, self.nodes, self.to_nodes, self.leaves, self.to_leaves = (EliasFano.of(arrays[3 * k:3 * k + 3]) for k in range(5))
        self.count, self.counts, self.back, self.backs, self.share, self.shares = arrays[15:21]

    @staticmethod
    def build(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """From distinct trigrams in order, with their counts."""
        node = starts(a, b)
        head = starts(a[node])
        total, kinds = np.add.reduceat(n, node), np.diff(np.append(node, len(n)))
        whole = total + kinds
        levels = [a[node][head], *relative(b[node], head), *relative(c, node)]
        out = [x for v in levels for x in EliasFano.encode(v).arrays()]
        for logs in (np.log10(total), np.log10(kinds / whole), np.log10(n / np.repeat(whole, kinds))):
            out += codes8(logs)
        return out

    def node(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The node of each context (sorted by a), or -1."""
        first = starts(a)
        head = self.heads.find(a[first])
        base, end = np.zeros(len(head), dtype=np.int64), np.zeros(len(head), dtype=np.int64)
        held = np.flatnonzero(head >= 0)
        base[held], end[held] = self.to_nodes.get_two(head[held])
        each = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(a))))
        out, value = np.full(len(a), -1, dtype=np.int64), base[each] + b
        inside = np.flatnonzero(value < end[each])
        out[inside] = self.nodes.find(value[inside])
        return out

    def leaf(self, node: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The leaf of each word after each node, or -1."""
        base, end = self.to_leaves.get_two(node)
        return np.where(base + c < end, self.leaves.find(base + c), -1)


def _save(path: str, arrays: list[np.ndarray]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(pack(arrays))
    os.replace(own, path)


def _load(path: str) -> list[np.ndarray]:
    with open(path, "rb") as f:
        return unpack(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def save_shards(folder: str, level: str, bits: int, keys: np.ndarray, values: list[np.ndarray]) -> list[tuple[int, int]]:
    """Files of the shards that ``keys`` (in order, distinct) are in; (shard,
    number of keys) of each."""
    part, out = keys >> (BITS - bits), []
    shards, at = np.unique(part, return_index=True)
    for shard, s, e in zip(shards, at, [*at[1:], len(keys)]):
        arrays = EliasFano.encode(keys[s:e] & ((1 << (BITS - bits)) - 1)).arrays()
        for v in values:
            big = np.flatnonzero(v[s:e] > 254)
            arrays += [np.minimum(v[s:e], 255).astype(np.uint8), big, v[s:e][big].astype("<i8")]
        _save(f"{folder}/{level}-{shard}", arrays)
        out.append((int(shard), int(e - s)))
    return out


class Level:
    """Shards of a level, opened as they are needed."""

    def __init__(self, folder: str, level: str, bits: int, sizes: dict[int, int] | None = None, values: int = 1):
        self.path, self.bits, self.values = f"{folder}/{level}", bits, values
        self.first, self.open, upto = {}, {}, 0
        for shard, n in sorted((sizes or {}).items()):
            self.first[shard], upto = upto, upto + n

    def shard(self, shard: int) -> tuple[EliasFano, list[np.ndarray]] | None:
        if shard not in self.open:
            if len(self.open) >= OPEN:
                self.open.pop(next(iter(self.open)))
            path = f"{self.path}-{shard}"
            arrays = _load(path) if os.path.exists(path) else None
            self.open[shard] = arrays and (EliasFano.of(arrays[:3]), arrays[3:])
        return self.open[shard]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rank of each key among all keys (-1 without one; within its shard
        if the sizes are not known), and its values (0 without one)."""
        u, back = np.unique(keys, return_inverse=True)
        rank, out = np.full(len(u), -1, np.int64), [np.zeros(len(u), np.int64) for _ in range(self.values)]
        shards, at = np.unique(u >> (BITS - self.bits), return_index=True)
        for shard, s, e in zip(shards.tolist(), at, [*at[1:], len(u)]):
            held = self.shard(shard)
            if held is None:
                continue
            coded, arrays = held
            pos = coded.find(u[s:e] & ((1 << (BITS - self.bits)) - 1))
            hit = np.flatnonzero(pos >= 0)
            rank[s + hit] = pos[hit] + self.first.get(shard, 0)
            for k in range(self.values):
                small, big, value = arrays[3 * k:3 * k + 3]
                got = small[pos[hit]].astype(np.int64)
                large = np.flatnonzero(got == 255)
                got[large] = value[np.searchsorted(big, pos[hit][large])]
                out[k][s + hit] = got
        return rank[back], [x[back] for x in out]


class Tries:
    """The shards of n-grams, opened as they are needed."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.open = folder, bits, {}

    def shard(self, shard: int) -> Trie | None:
        if shard not in self.open:
            if len(self.open) >= OPEN:
                self.open.pop(next(iter(self.open)))
            path = f"{self.folder}/trie-{shard}"
            self.open[shard] = Trie(_load(path)) if os.path.exists(path) else None
        return self.open[shard]

    def _each(self, shard: np.ndarray):
        """(trie, places in ``shard``) of every shard that is there."""
        order = by_shard(shard)
        at = starts(shard[order])
        for s, e in zip(at, [*at[1:], len(order)]):
            trie = self.shard(int(shard[order[s]]))
            if trie is not None:
                yield trie, order[s:e]

    def contexts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """For contexts sorted by a and b: shard, node (-1 without one), the
        context's count and its back-off weight (0 without one)."""
        shard = shard_of(a, b, self.bits)
        node, count, back = np.full(len(a), -1, dtype=np.int64), np.zeros(len(a)), np.zeros(len(a))
        for trie, at in self._each(shard):
            found = trie.node(a[at], b[at])
            at, found = at[found >= 0], found[found >= 0]
            node[at], count[at], back[at] = found, 10 ** trie.counts[trie.count[found]], 10 ** trie.backs[trie.back[found]]
        return shard, node, count, back

    def shares(self, shard: np.ndarray, node: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The share of each word c after a node (0 without a leaf)."""
        out = np.zeros(len(c))
        for trie, at in self._each(shard):
            leaf = trie.leaf(node[at], c[at])
            at, leaf = at[leaf >= 0], leaf[leaf >= 0]
            out[at] = 10 ** trie.shares[trie.share[leaf]]
        return out


class Shards:
    """Where the model is, and its few numbers."""

    def __init__(self, folder: str, salt: int, sizes: dict[int, int], bits1: int, total: int, kinds: int, texts: int):
        self.folder, self.salt, self.sizes, self.bits1 = folder, salt, sizes, bits1
        self.total, self.kinds, self.texts, self.bits = total, kinds, texts, shard_bits(total)
        self.unseen, self.start, self.stop = kinds, kinds + 1, kinds + 2
        if kinds + 3 >= 1 << ID_BITS:
            raise ValueError("more words than ids")

    def words(self) -> Level:
        return Level(self.folder, "words", self.bits1, self.sizes)

    def successors(self, ids: np.ndarray) -> np.ndarray:
        """Number of distinct words after each id."""
        out = np.zeros(len(ids), np.int64)
        for block in np.unique(ids // BLOCK):
            if os.path.exists(f"{self.folder}/after-{block}"):
                at = np.flatnonzero(ids // BLOCK == block)
                out[at] = _load(f"{self.folder}/after-{block}")[0][ids[at] % BLOCK]
        return out


def _ids(model: Shards, level: Level, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rank, (n,) = level.find(hashes(words, model.salt))
    return np.where(rank >= 0, rank, model.unseen), n


def store_words(vocabulary: DataFrame, total: int, kinds: int, texts: int) -> Shards:
    """The first level, from ``word_counts``."""
    spark = vocabulary.sparkSession
    base = urlparse(scratch_path(spark, f"llm/lm-{uuid.uuid4().hex}"))
    if base.scheme not in ("", "file"):
        raise ValueError(f"the model's shards need a checkpoint folder that every executor can map, not {base.scheme}://")
    bits = shard_bits(kinds)
    for salt in range(100):
        folder = f"{base.path}/{salt}"

        def deal(batches, salt=salt):
            for b in batches:
                h = hashes(b.column("word"), salt)
                o = np.argsort(h)
                if len(o):
                    yield packed(h[o] >> (BITS - bits), [h[o], b.column("n").to_numpy()[o]])

        def write(batches, folder=folder):
            keys, n = unpacked(batches, 2)
            o = np.argsort(keys)
            keys, n = keys[o], n[o]
            once = np.append(True, np.diff(keys) > 0)[:len(keys)]
            done = save_shards(folder, "words", bits, keys[once], [n[once]])
            yield pa.RecordBatch.from_pylist([{"shard": s, "n": k} for s, k in done], pa.schema([("shard", pa.int64()), ("n", pa.int64())]))
        rows = vocabulary.mapInArrow(deal, "shard long, data binary").repartitionById(1 << bits, F.col("shard").cast("int")).mapInArrow(write, "shard long, n long").collect()
        sizes = {r.shard: r.n for r in rows}
        if sum(sizes.values()) == kinds:
            return Shards(folder, salt, sizes, bits, total, kinds, texts)
    raise ValueError("word hashes collide")


def sequence(ids: np.ndarray, per: np.ndarray, start: int, end: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, each between a start mark and an end
    token with a stop mark; and the position of every word."""
    size = per + 3
    ends = np.cumsum(size)
    out = np.empty(int(size.sum()), np.int64)
    out[ends - size], out[ends - 2], out[ends - 1] = start, end, stop
    at = np.arange(len(ids)) + 3 * np.repeat(np.arange(len(per)), per) + 1
    out[at] = ids
    return out, at


def store_grams(texts: DataFrame, model: Shards) -> None:
    """The tries and the number of words after each word, in one pass over the
    texts.  A bigram's count is that of the trigrams that begin with it (the
    end token has the stop mark after it)."""
    from docflow.llm.lm import tokens
    folder, bits = model.folder, model.bits

    def counted(parts):
        # a chunk has under 2 ** 21 different words: three local numbers make one key
        ids = np.unique(np.concatenate([own for own, _ in parts]))
        local = np.concatenate([np.searchsorted(ids, own)[seq] for own, seq in parts])
        opens = local == np.searchsorted(ids, model.start)
        keep = ~(opens[2:] | opens[1:-1])
        key = np.sort(((local[:-2] << 42) | (local[1:-1] << 21) | local[2:])[keep])
        at = starts(key)
        n, key = np.diff(np.append(at, len(key))), key[at]
        a, b, c = (ids[(key >> k) & ((1 << 21) - 1)] for k in (42, 21, 0))
        shard = shard_of(a, b, bits)
        o = by_shard(shard)
        return packed(shard[o], [x[o] for x in (a, b, c, n)])

    def count(batches):
        level = model.words()
        (end,), _ = _ids(model, level, pa.array([""]))
        parts, size = [], 0
        for batch in batches:
            flat, per = tokens(batch.column("t"))
            coded = flat.dictionary_encode()
            ids, _ = _ids(model, level, coded.dictionary)
            own, k = np.append(ids, [model.start, end, model.stop]), len(ids)
            seq, _ = sequence(coded.indices.to_numpy(zero_copy_only=False), per, k, k + 1, k + 2)
            for at in range(0, len(seq), CHUNK):
                # a later piece takes the last two positions again, and never follows its forerunner in a chunk
                piece = seq[max(0, at - 2):at + CHUNK]
                if parts and (at or size + len(piece) > CHUNK):
                    yield counted(parts)
                    parts, size = [], 0
                parts.append((own, piece))
                size += len(piece)
        if parts:
            yield counted(parts)

    def tries(batches):
        a, b, c, n = unpacked(batches, 4)
        if not len(n):
            return
        # the chunks are in order, so both sorts merge runs
        pair = (a << ID_BITS) | b
        o = np.argsort(pair, kind="stable")
        pair, c, n = pair[o], c[o], n[o]
        rank = np.zeros(len(pair), dtype=np.int64)
        rank[starts(pair)[1:]] = 1
        o = np.argsort((np.cumsum(rank) << ID_BITS) | c, kind="stable")
        c, n = c[o], n[o]
        at = starts(pair, c)
        pair, c, n = pair[at], c[at], np.add.reduceat(n, at)
        a, b = pair >> ID_BITS, pair & ((1 << ID_BITS) - 1)
        _save(f"{folder}/trie-{shard_of(a[:1], b[:1], bits)[0]}", Trie.build(a, b, c, n))
        word, k = np.unique(a[starts(pair)], return_counts=True)
        yield packed(word // BLOCK, [word, k])

    def after(batches):
        word, k = unpacked(batches, 2)
        for block in np.unique(word // BLOCK):
            of = word // BLOCK == block
            _save(f"{folder}/after-{block}", [np.bincount(word[of] % BLOCK, k[of], BLOCK).astype("<u4")])
        yield pa.RecordBatch.from_pylist([{"n": int(k.sum())}], pa.schema([("n", pa.int64())]))

    form, number = "shard long, data binary", F.col("shard").cast("int")      # a task for each shard
    dealt = texts.mapInArrow(count, form).repartitionById(1 << bits, number).mapInArrow(tries, form)
    dealt.repartitionById(model.stop // BLOCK + 1, number).mapInArrow(after, "n long").agg(F.sum("n")).collect()


def score_texts(docs: DataFrame, model: Shards, alpha: float) -> DataFrame:
    """(doc_id, held_out, t) -> doc_id, held_out, n_tokens, n_known,
    base_score, score."""
    from docflow.llm.lm import tokens
    norm = model.total + alpha * (model.kinds + 1)

    def scored(rows, level, tries):
        end, (n_end,) = _ids(model, level, pa.array([""]))
        flat, per = tokens(rows.column("t"))
        coded = flat.dictionary_encode()
        ids, n = _ids(model, level, coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        after = model.successors(ids)
        seq, at = sequence(ids[codes], per, model.start, end[0], model.stop)
        doc = np.repeat(np.arange(len(per)), per + 3)
        count, follow = np.zeros(len(seq), np.int64), np.zeros(len(seq), np.int64)
        count[at], follow[at] = n[codes], after[codes]
        opens, ends = seq == model.start, np.cumsum(per + 3) - 2
        count[opens], follow[opens] = model.texts, model.successors(np.array([model.start]))[0]
        count[ends] = n_end
        real = np.flatnonzero(~opens & (seq != model.stop))
        low = (count[real] + alpha) / norm
        # each different pair of known words is looked up once, as bigram and as context
        known = real[(count[real - 1] > 0) & (count[real] > 0)]
        pairs, which = np.unique((seq[known - 1] << ID_BITS) | seq[known], return_inverse=True)
        shard, node, total, back = tries.contexts(pairs >> ID_BITS, pairs & ((1 << ID_BITS) - 1))
        pair = np.full(len(seq), -1, dtype=np.int64)       # of the word at a place and the one before it
        pair[known] = which
        pick = lambda values, of: np.where(of >= 0, values[np.maximum(of, 0)] if len(values) else 0.0, 0.0)
        seen, n1, k1 = pick(total, pair[real]), count[real - 1], follow[real - 1]
        mid = np.where(n1 > 0, (seen + k1 * low) / np.maximum(1, n1 + k1), low)
        context = pair[real - 1]
        weight = pick(back, context)
        maybe = np.flatnonzero((weight > 0) & (seen > 0))
        keys, which = np.unique(context[maybe] * (model.stop + 1) + seq[real[maybe]], return_inverse=True)
        of, word = np.divmod(keys, model.stop + 1)
        share = np.zeros(len(real))
        share[maybe] = tries.shares(shard[of], node[of], word)[which]
        top = np.where(weight > 0, share + weight * mid, mid)
        sums = lambda x: np.bincount(doc[real], x, len(per))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("held_out"), pa.array(per + 1, pa.int64()),
             pa.array(sums(count[real] > 0).astype(np.int64)), pa.array(sums(np.log10(low))), pa.array(sums(np.log10(top)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    def run(batches):
        levels = model.words(), Tries(model.folder, model.bits)
        for b in batches:
            upto = np.cumsum(pc.binary_length(b.column("t")).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(upto):
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PIECE, side="right")))
                yield scored(b.take(pa.array(np.arange(at, end))), *levels)      # a copy: the kernels of tokens() misread slices
                at = end
    return docs.select("doc_id", "held_out", "t").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def train(texts: DataFrame, vocabulary: DataFrame) -> Shards:
    """Model of the texts (t); ``vocabulary`` is their ``word_counts``."""
    r = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("kinds"),
                       F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0)).alias("texts")).first()
    model = store_words(vocabulary, int(r.total), int(r.kinds), int(r.texts))
    if model.kinds:
        store_grams(texts, model)
    return model
