"""Elias-Fano coding of monotone sequences, with vectorised lookups.

A value keeps its low bits in a packed array; its high bits are written in
unary in a bit vector with a count of zeros for every 64-bit word.  All parts
are flat little-endian arrays, so a level can be opened in place from a byte
buffer or a memory-mapped file.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: Place of the k-th (from 0) one bit of each byte (8: there is none).
_IN_BYTE = np.array([[*np.flatnonzero(row), *[8] * 8][:8] for row in _ONES], dtype=np.uint8).ravel()


def _bit_select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) one bit of each word."""
    octets = np.ascontiguousarray(word).view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.uint8)
    at = (upto <= k.astype(np.uint8)[:, None]).sum(axis=1, dtype=np.int64)
    row = np.arange(len(at)) * 8 + at
    before = np.where(at > 0, upto.ravel()[row - 1], 0)
    return at * 8 + _IN_BYTE[octets.ravel()[row].astype(np.int64) * 8 + k - before]


def _trailing(x: np.ndarray) -> np.ndarray:
    """Number of zeros below the lowest one bit (64: there is none)."""
    return np.bitwise_count((x & (~x + U64(1))) - U64(1)).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of integers below 2**62."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(high) + 1, dtype=np.int64) * 64 - self.ones
        self.mask = U64((1 << low_bits) - 1)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, int(np.floor(np.log2(max(1, (top + 1) / max(1, n))))))
        low = np.zeros((n * bits + 63) // 64 + 1, dtype=U64)
        part = v & U64((1 << bits) - 1)
        at = np.arange(n, dtype=np.int64) * bits
        word, off = at >> 6, (at & 63).astype(np.uint64)
        if bits:
            np.bitwise_or.at(low, word, part << off)
            over = (off.astype(np.int64) + bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - off[over]))
        pos = (v >> U64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(((int(pos[-1]) + 2 if n else 1) + 63) // 64 * 64, dtype=np.uint8)
        flags[pos] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little").view("<u8"))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], dtype="<i8"), self.low, self.high]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        return cls(int(arrays[0][0]), int(arrays[0][1]), arrays[1], arrays[2])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=U64)
        at = i * self.low_bits
        word, off = at >> 6, (at & 63).astype(np.uint64)
        rest = np.where(off > 0, self.low[word + 1] << ((U64(64) - off) & U64(63)), U64(0))
        return ((self.low[word] >> off) | rest) & self.mask

    def _place(self, i: np.ndarray) -> np.ndarray:
        """Places of the one bits of the elements ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        return word * 64 + _bit_select(self.high[word], i - self.ones[word])

    def _value(self, place: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (((place - i).astype(np.uint64) << U64(self.low_bits)) | self._low(i)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        i = np.asarray(i, dtype=np.int64)
        return self._value(self._place(i), i)

    def get_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at positions ``i`` and ``i + 1``: the second one's bit is
        mostly in the word of the first."""
        i = np.asarray(i, dtype=np.int64)
        first = self._place(i)
        rest = (self.high[first >> 6] >> (first & 63).astype(U64)) >> U64(1)
        second = first + 1 + _trailing(rest)
        far = np.flatnonzero(rest == 0)
        second[far] = self._place(i[far] + 1)
        return self._value(first, i), self._value(second, i + 1)

    def _bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of elements whose high part is below ``h``, and of those
        with ``h`` at most."""
        lo = np.zeros(len(h), dtype=np.int64)
        place = np.full(len(h), -1, dtype=np.int64)       # of the zero before the bucket
        inside = np.flatnonzero((h > 0) & (h <= self.zeros[-1]))
        k = h[inside] - 1                     # the h-th zero ends the elements below h
        word = np.searchsorted(self.zeros, k, side="right") - 1
        place[inside] = word * 64 + _bit_select(~self.high[word], k - self.zeros[word])
        lo[inside] = place[inside] - k
        beyond = h > self.zeros[-1]
        lo[beyond], place[beyond] = self.n, 64 * len(self.high) - 1
        run, at = np.zeros(len(h), dtype=np.int64), place + 1
        live = np.flatnonzero(at < 64 * len(self.high))
        while len(live):                      # the run of ones, word by word
            left = 64 - (at[live] & 63)
            ones = np.minimum(_trailing(~(self.high[at[live] >> 6] >> (at[live] & 63).astype(U64))), left)
            run[live] += ones
            at[live] += ones
            live = live[(ones == left) & (at[live] < 64 * len(self.high))]
        return lo, lo + run

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each value ``x`` (the first, if it repeats), or -1."""
        x = np.asarray(x, dtype=np.int64)
        if not self.n:
            return np.full(len(x), -1, dtype=np.int64)
        valid = x >= 0
        v = np.where(valid, x, 0).astype(np.uint64)
        want = v & self.mask
        lo, end = self._bucket((v >> U64(self.low_bits)).astype(np.int64))
        hi = end.copy()
        live = np.flatnonzero(hi - lo > 1)
        while len(live):                      # successor search among the low bits of the bucket
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid - 1) < want[live]
            lo[live[less]] = mid[less]
            hi[live[~less]] = mid[~less]
            live = live[hi[live] - lo[live] > 1]
        hit = np.flatnonzero(valid & (lo < end))
        out = np.full(len(x), -1, dtype=np.int64)
        same = self._low(lo[hit]) == want[hit]
        out[hit[same]] = lo[hit[same]]
        return out


def pack(arrays: list[np.ndarray]) -> bytes:
    """Flat file: number of arrays, their types and lengths, then the data."""
    head = [str(len(arrays))] + [f"{a.dtype.str}:{len(a)}" for a in arrays]
    first = ("\n".join(head) + "\n\n").encode()
    first += b" " * (-len(first) % 8)
    body = b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)
    return len(first).to_bytes(8, "little") + first + body


def unpack(buffer) -> list[np.ndarray]:
    """The arrays of ``pack``, as views of ``buffer`` (bytes or a memory map)."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    size = int(view[:8].view("<u8")[0])
    lines = bytes(view[8:8 + size]).decode().split("\n")
    at, out = 8 + size, []
    for line in lines[1:1 + int(lines[0])]:
        kind, n = line.rsplit(":", 1)
        nbytes = np.dtype(kind).itemsize * int(n)
        out.append(view[at:at + nbytes].view(kind))
        at += nbytes + (-nbytes % 8)
    return out
