"""Elias-Fano sequences in numpy: building, select, access and successor search, all vectorised.

A sequence of n non-decreasing integers below u takes about n * (2 + log2(u / n)) bits: the low bits
packed, the high bits in unary. The rank directory, one 32-bit count a 64-bit word of the unary part,
adds about one bit a value, and the words that hold every SAMPLE-th one and zero, for select, two more at
most. All parts are plain arrays, so a sequence can be memory-mapped.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping

import numpy as np

U64 = np.uint64
ONE = U64(1)
_bytes = np.arange(256, dtype=np.uint8)
_bits = (_bytes[:, None] >> np.arange(8, dtype=np.uint8)) & 1
#: SELECT_IN_BYTE[b, k]: place of the k-th set bit of byte b.
SELECT_IN_BYTE = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _p = np.flatnonzero(_bits[_b])
    SELECT_IN_BYTE[_b, : len(_p)] = _p
SPREAD = U64(0x0101010101010101)
#: Ones or zeros between two samples (as a power of two), and words tried after a sample before a binary search.
SAMPLE, STEPS = 5, 4


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, one after the other, in 64-bit words with one to spare."""
    n = len(values)
    out = np.zeros((n * width + 63) // 64 + 1, U64)
    if not width or not n:
        return out
    at = np.arange(n, dtype=U64) * U64(width)
    word, bit = (at >> U64(6)).astype(np.int64), at & U64(63)
    v = values.astype(U64) & U64((1 << width) - 1)
    # values rise in place, so those that begin in one word are neighbours
    begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[begin]] |= np.bitwise_or.reduceat(v << bit, begin)
    over = np.flatnonzero(bit + U64(width) > U64(64))
    out[word[over] + 1] |= v[over] >> (U64(64) - bit[over])
    return out


def unpack(packed: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(i), U64)
    at = i.astype(U64) * U64(width)
    word, bit = (at >> U64(6)).astype(np.int64), at & U64(63)
    v = packed[word] >> bit
    up = packed[word + 1] << ((U64(64) - bit) & U64(63))
    return (v | np.where(bit == 0, U64(0), up)) & U64((1 << width) - 1)


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit of each word."""
    # byte-wise popcounts, then their prefix sums
    x = words - ((words >> ONE) & U64(0x5555555555555555))
    x = (x & U64(0x3333333333333333)) + ((x >> U64(2)) & U64(0x3333333333333333))
    x = (x + (x >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)
    sums = x * SPREAD
    # the byte is the number of prefix sums that are at most k
    low = (((k.astype(U64) * SPREAD) | U64(0x8080808080808080)) - sums) & U64(0x8080808080808080)
    byte = np.bitwise_count(low).astype(U64)
    shift = byte * U64(8)
    before = np.where(byte == 0, U64(0), (sums >> (shift - U64(8) * (byte > 0))) & U64(255))
    return shift.astype(np.int64) + SELECT_IN_BYTE[((words >> shift) & U64(255)).astype(np.int64), (k.astype(U64) - before).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence below ``universe``."""

    def __init__(self, n: int, universe: int, width: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.universe, self.width = n, universe, width
        self.low, self.high, self.ranks, self.ones, self.zeros = low, high, ranks, ones, zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int | None = None) -> EliasFano:
        v = np.asarray(values, U64)
        n = len(v)
        u = int(universe if universe is not None else (int(v[-1]) + 1 if n else 1))
        if n and (int(v[-1]) >= u or (v[1:] < v[:-1]).any()):
            raise ValueError("values must not decrease and must lie below the universe")
        width = max(0, (u // max(n, 1)).bit_length() - 1)
        at = (v >> U64(width)) + np.arange(n, dtype=U64)
        size = (n + (u >> width) + 2 + 63) // 64
        high = np.zeros(size, U64)
        if n:
            word = (at >> U64(6)).astype(np.int64)
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            high[word[begin]] = np.bitwise_or.reduceat(ONE << (at & U64(63)), begin)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        empty = np.arange(size + 1) * 64 - ranks
        samples = [(np.searchsorted(x, np.arange(0, max(1, int(x[-1])), 1 << SAMPLE), side="right") - 1).astype(np.uint32) for x in (ranks, empty)]
        return cls(n, u, width, pack(v, width), high, ranks.astype(np.uint32), *samples)

    def word(self, k: np.ndarray, samples: np.ndarray, before: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The word that holds the k-th one or zero; ``before`` counts those before a word."""
        word = samples[k >> SAMPLE].astype(np.int64)
        todo: np.ndarray | slice = slice(None)
        for _ in range(STEPS):
            later = before(word[todo] + 1) <= k[todo]
            todo = np.flatnonzero(later) if isinstance(todo, slice) else todo[later]
            if not len(todo):
                return word
            word[todo] += 1
        # a long run: bisect up to the next sample
        last = np.minimum((k[todo] >> SAMPLE) + 1, len(samples) - 1)
        low, high = word[todo], np.where(last > k[todo] >> SAMPLE, samples[last].astype(np.int64), len(self.high) - 1)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            up = before(mid) <= k[todo]
            low, high = np.where(up, mid, low), np.where(up, high, mid - 1)
        word[todo] = low
        return word

    def select1(self, k: np.ndarray) -> np.ndarray:
        """Bit place of the k-th one, for 0 <= k < n."""
        word = self.word(k, self.ones, lambda w: self.ranks[w].astype(np.int64))
        return word * 64 + select_in_word(self.high[word], k - self.ranks[word])

    def select0(self, k: np.ndarray) -> np.ndarray:
        """Bit place of the k-th zero, for 0 <= k <= universe >> width."""
        before = lambda w: w * 64 - self.ranks[w]
        word = self.word(k, self.zeros, before)
        return word * 64 + select_in_word(~self.high[word], k - before(word))

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, U64)
        return ((self.select1(i) - i).astype(U64) << U64(self.width)) | unpack(self.low, self.width, i)

    def __len__(self) -> int:
        return self.n

    def bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First element and the one after the last of those with high part h (each at most universe >> width)."""
        begin = np.zeros(len(h), np.int64)
        later = h > 0
        begin[later] = self.select0(h[later] - 1) + 1
        # the next zero ends the bucket, mostly in the same word
        word = begin >> 6
        rest = ~self.high[word] >> (begin & 63).astype(U64)
        end = begin + np.bitwise_count((rest & (~rest + ONE)) - ONE).astype(np.int64)
        far = np.flatnonzero(rest == 0)
        if len(far):
            end[far] = self.select0(h[far])
        return begin - h, end - h

    def lower_bound(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """In a bucket's range, the first element whose low part isn't below that of x, or ``end``.

        A binary search: elements of a crowded context may share one high part.
        """
        lo, hi = begin.copy(), end.copy()
        want = x & U64((1 << self.width) - 1)
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            below = unpack(self.low, self.width, mid) < want[todo]
            lo[todo[below]] = mid[below] + 1
            hi[todo[~below]] = mid[~below]
            todo = todo[lo[todo] < hi[todo]]
        return lo

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and value of the first element >= x; index n and value universe where there is none."""
        x = np.asarray(x, U64)
        index = np.full(len(x), self.n, np.int64)
        value = np.full(len(x), self.universe, U64)
        todo = np.flatnonzero(x < U64(self.universe)) if self.n else np.zeros(0, np.int64)
        if len(todo):
            begin, end = self.bucket((x[todo] >> U64(self.width)).astype(np.int64))
            index[todo] = self.lower_bound(x[todo], begin, end)  # past the bucket comes the next element
            there = todo[index[todo] < self.n]
            value[there] = self.access(index[there])
        return index, value

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of x, or -1: the successor search within x's bucket."""
        x = np.asarray(x, U64)
        out = np.full(len(x), -1, np.int64)
        todo = np.flatnonzero(x < U64(self.universe)) if self.n else np.zeros(0, np.int64)
        if not len(todo):
            return out
        begin, end = self.bucket((x[todo] >> U64(self.width)).astype(np.int64))
        at = self.lower_bound(x[todo], begin, end)
        inside = at < end
        todo, at = todo[inside], at[inside]
        same = unpack(self.low, self.width, at) == (x[todo] & U64((1 << self.width) - 1))
        out[todo[same]] = at[same]
        return out

    def parts(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.head": np.array([self.n, self.universe, self.width], U64), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ranks": self.ranks, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def of(cls, arrays: Mapping[str, np.ndarray], name: str) -> EliasFano:
        n, u, w = (int(x) for x in arrays[f"{name}.head"])
        return cls(n, u, w, arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.ranks"], arrays[f"{name}.ones"], arrays[f"{name}.zeros"])

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.low, self.high, self.ranks, self.ones, self.zeros))


def write(path: str, arrays: Mapping[str, np.ndarray]) -> None:
    """All arrays in one file, under another name until it is whole: a retried or doubled task does no harm."""
    heads, at = {}, 0
    for k, a in arrays.items():
        heads[k] = [a.dtype.str, len(a), at]
        at += (a.nbytes + 7) // 8 * 8
    head = json.dumps(heads).encode()
    head += b" " * (-(len(head) + 8) % 8)
    other = f"{path}.{uuid.uuid4().hex}"
    with open(other, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8))
    os.replace(other, path)


def read(path: str) -> dict[str, np.ndarray]:
    """The arrays of :func:`write`, memory-mapped."""
    whole = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(whole[:8].tobytes(), "little")
    heads = json.loads(whole[8 : 8 + size].tobytes())
    base = np.asarray(whole)[8 + size :]
    return {k: base[at : at + n * np.dtype(d).itemsize].view(d) for k, (d, n, at) in heads.items()}
