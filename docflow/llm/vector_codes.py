"""Product codes of vectors in integers only, with an early-ending search.

A component x becomes floor(4096 * x).  Vectors are cut into equal parts, and
each part position has a codebook of up to ``entries`` entries, refined by
rounds of assigning every part to its nearest entry and replacing an entry
by the floor of its parts' mean.

The search works on Walsh-Hadamard coefficients: parts and entries are padded
with zeros to n, a power of two, and transformed with sums and differences
only.  Squared differences of coefficients add up to exactly n times the
squared distance.  They are added in sequency order (few sign changes first,
where neighbouring components that go together put most of their weight); an
entry whose scaled sum already passes that of a fully measured one is out.
All arithmetic is on 64-bit integers, so ties are exact (lower index wins).

Every round is one pass over the written integer vectors in Arrow batches; a
task sums its parts by position and entry, so what is exchanged and what
reaches the driver is one row a position, entry and component, whatever the
number of vectors.  The codebooks (``parts * entries`` entries) travel with
the tasks.

Defined cases: rows whose vector is null or holds a null or non-finite
component are dropped; null ids come last among the first ids, and of equal ids the
lesser vector first; repeated rows are rows; vectors shorter than the longest, and
lengths that do not divide into the parts, are filled with zeros at the end;
fewer vectors than entries give smaller codebooks; an empty table gives no
row; a component beyond ``limit`` (8,192 in size for parts of 5 to 8 and 16
entries) is refused with a message, as its squares could pass 64 bits; input
columns other than id, vector and label are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6


def power_of_two(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def limit(n: int, entries: int) -> int:
    """The largest integer component for parts padded to ``n``: coefficients
    of a difference are up to 2 n components, their squares add up to at most
    4 n n components squared, and that times ``entries`` stays below 2 ** 62."""
    bits = 62 - 2 - 2 * (n.bit_length() - 1) - (power_of_two(entries).bit_length() - 1)
    return 1 << bits // 2


def sequency(n: int) -> np.ndarray:
    """Places of the transform's rows by their number of sign changes."""
    rows = np.ones((1, 1), dtype=np.int64)
    while len(rows) < n:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def walsh(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Coefficients of the rows of ``x``, padded with zeros, in ``order``."""
    n = len(order)
    y = np.zeros((len(x), n), dtype=np.int64)
    y[:, :x.shape[1]] = x
    half = 1
    while half < n:
        z = y.reshape(len(y), -1, 2, half)
        y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], axis=2).reshape(len(y), n)
        half *= 2
    return y[:, order]


def nearest(p: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For coefficients of parts (m x n) and entries (k x n): the nearest
    entry of each part (ties to the lower index) and the scaled distance."""
    m, n, k = len(p), p.shape[1], len(e)
    first = (p[:, :1] - e[:, 0]) ** 2
    guess = first.argmin(axis=1)
    bound = ((p - e[guess]) ** 2).sum(axis=1)          # one entry measured in full
    rows, cols = np.nonzero(first <= bound[:, None])
    part = first[rows, cols]
    for c in range(1, n):
        part = part + (p[rows, c] - e[cols, c]) ** 2
        stay = part <= bound[rows]
        rows, cols, part = rows[stay], cols[stay], part[stay]
    best = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(best, rows, part * k + cols)          # distance, then index
    return best % k, best // k


@dataclass
class Codebooks:
    """``entries`` by part: integer arrays (entry x component)."""

    entries: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (m x parts) and squared distances (m x parts)."""
        n = power_of_two(self.width)
        order = sequency(n)
        codes, dist = [], []
        for i, e in enumerate(self.entries):
            c, d = nearest(walsh(vectors[:, i * self.width:(i + 1) * self.width], order), walsh(e, order))
            codes.append(c)
            dist.append(d // n)
        return np.stack(codes, axis=1), np.stack(dist, axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel()).encode()).hexdigest()


def integers(rows: DataFrame, parts: int, entries: int, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """The kept rows (id, label, vector of longs, all of one length that
    ``parts`` divides) as a written table, and that length."""
    x = F.col(vector_col)
    fits = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    kept = rows.filter(x.isNotNull() & fits).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double")).alias("v"))
    kept = materialize(kept, "vector-input")
    length, most = kept.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    length = -(-(length or 0) // parts) * parts
    if (most or 0) > limit(power_of_two(length // parts), entries):
        raise ValueError(f"a component of {most / SCALE:g} is too large for exact 64-bit distances")
    filled = F.slice(F.concat(F.transform("v", lambda v: v.cast("long")), F.array_repeat(F.lit(0).cast("long"), length)), 1, length)
    return kept.select("id", "label", filled.alias("v")), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def part_sums(books: Codebooks, length: int):
    """Sums and counts of a task's parts by position and entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(e) for e in books.entries]
        counts = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
        for b in batches:
            v = matrix(b.column(0), length)
            codes, _ = books.assign(v)
            for i, c in enumerate(codes.T):
                np.add.at(sums[i], c, v[:, i * books.width:(i + 1) * books.width])
                counts[i] += np.bincount(c, minlength=len(counts[i]))
        rows = [(i, j, int(counts[i][j]), k, int(s)) for i in range(len(sums)) for j in range(len(sums[i])) if counts[i][j]
                for k, s in enumerate(sums[i][j])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                                             names=["part", "entry", "n", "k", "total"])
    return run


def train(vectors: DataFrame, length: int, parts: int, entries: int, rounds: int) -> Codebooks | None:
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    start = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), length)
    width = length // parts
    books = Codebooks([start[:, i * width:(i + 1) * width].copy() for i in range(parts)])
    for _ in range(rounds if width else 0):
        sums = vectors.select("v").mapInArrow(part_sums(books, length), "part int, entry int, n long, k int, total long")
        got = sums.groupBy("part", "entry", "k").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        for r in got:
            books.entries[r.part][r.entry, r.k] = r.total // r.n
    return books


def encode(books: Codebooks, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, dist = books.assign(matrix(b.column("v"), length))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array(list(codes.astype(np.uint8)), type=pa.list_(pa.uint8())).cast(pa.list_(pa.int16())),
                 pa.array(dist.sum(axis=1), type=pa.int64())], names=["id", "label", "codes", "error"])
    return run


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """The kept rows as a written table (id, label, codes: array of one
    small number a part, error: the squared distance to what the codes stand
    for) and the codebooks (None for an empty table).  At most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    vectors, length = integers(rows, parts, entries, id_col, vector_col, label_col)
    books = train(vectors, length, parts, entries, rounds)
    schema = f"id {vectors.schema['id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, codes array<smallint>, error bigint"
    if books is None:
        return rows.sparkSession.createDataFrame([], schema), None
    return materialize(vectors.mapInArrow(encode(books, length), schema), "vector-codes"), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors summed over equal labels (nulls
    together).  The sums are written first, so that a hot label is split."""
    sums = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
