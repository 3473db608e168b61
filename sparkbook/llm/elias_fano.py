"""Elias-Fano sequences and trie levels on read-only byte buffers, vectorised with numpy.

A monotone sequence keeps the low bits of each value packed side by side and
the high bits in unary: value i sets bit (high_i + i). A directory of ones per
64-bit word finds the i-th one and the i-th zero. Everything is read through
views of one buffer (a memory-mapped file or an Arrow buffer); nothing is
unpacked when a level is opened.
"""

from __future__ import annotations

import struct

import numpy as np

_PLACE = np.zeros((256, 8), np.uint8)  # place of the k-th one in a byte
for _byte in range(256):
    _ones = [b for b in range(8) if _byte >> b & 1]
    _PLACE[_byte, : len(_ones)] = _ones
_U = np.uint64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits side by side in 64-bit words, with one spare word."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.uint64) * _U(width)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        # Bits of different values never meet, so sums per word are ors.
        out += _sum_at(word, values << shift, len(out))
        spill = np.where(shift > 0, values >> (_U(64) - np.maximum(shift, _U(1))), _U(0))
        out += _sum_at(word + 1, spill, len(out))
    return out


def _sum_at(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values per place; ``at`` is sorted."""
    out = np.zeros(size, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out[at[first]] = np.add.reduceat(values, first)
    return out


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one of each word."""
    x = words - ((words >> _U(1)) & _U(0x5555555555555555))
    x = (x & _U(0x3333333333333333)) + ((x >> _U(2)) & _U(0x3333333333333333))
    x = ((x + (x >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _U(0x0101010101010101)
    upto = x.astype("<u8").view(np.uint8).reshape(-1, 8)  # ones up to each byte
    k = k.astype(np.uint8)
    byte = np.minimum((upto <= k[:, None]).sum(axis=1, dtype=np.uint8), 7)
    shift = byte.astype(np.uint64) << _U(3)
    before = np.where(byte > 0, (x << _U(8)) >> shift & _U(255), _U(0)).astype(np.uint8)
    return byte.astype(np.int64) * 8 + _PLACE[(words >> shift & _U(255)).astype(np.uint8), (k - before) & 7]


class EliasFano:
    """A monotone sequence of unsigned numbers below 2^63."""

    def __init__(self, buffer):
        self.n, self.width, n_low, n_high, self.last = struct.unpack_from("<5Q", buffer)
        at = 40
        self.low = np.frombuffer(buffer, "<u8", n_low, at)
        self.high = np.frombuffer(buffer, "<u8", n_high, at + 8 * n_low)
        self.ones = np.frombuffer(buffer, "<u4", n_high + 1, at + 8 * (n_low + n_high))
        self.size = at + 8 * (n_low + n_high) + 4 * (n_high + 1)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (last // n).bit_length() - 1) if n else 0
        high = np.zeros(((last >> width) + n) // 64 + 1, np.uint64)
        if n:
            bit = (values >> _U(width)) + np.arange(n, dtype=np.uint64)
            high += _sum_at((bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)), len(high))
        low = _pack(values & _U((1 << width) - 1), width)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]).astype("<u4")
        return struct.pack("<5Q", n, width, len(low), len(high), last) + low.astype("<u8").tobytes() + high.astype("<u8").tobytes() + ones.tobytes()

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.width)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        got = (self.low[word] >> shift) | np.where(shift > 0, self.low[word + 1] << (_U(64) - np.maximum(shift, _U(1))), _U(0))
        return got & _U((1 << self.width) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        word = np.searchsorted(self.ones, i, "right") - 1
        bit = word * 64 + _select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((bit - i).astype(np.uint64) << _U(self.width)) | self.lows(i)

    def _after_zeros(self, k: np.ndarray) -> np.ndarray:
        """How many ones come before the k-th zero (k from 1; 0 gives 0): values whose high part is below k."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        k = np.minimum(k, zeros[-1])
        word = np.maximum(np.searchsorted(zeros, k, "left") - 1, 0)
        inside = np.maximum(k - 1 - zeros[word], 0)
        bit = word * 64 + _select_in_word(~self.high[word], inside)
        return np.where(k > 0, bit - (k - 1), 0)

    def find(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value not below each target (n if none), and whether it is the target."""
        if not self.n:
            return np.zeros(len(targets), np.int64), np.zeros(len(targets), bool)
        high = np.minimum(targets >> _U(self.width), _U(self.last >> self.width) + _U(1)).astype(np.int64)
        lo, hi = self._after_zeros(high), self._after_zeros(high + 1)
        hi = np.where(high > (self.last >> self.width), lo, np.minimum(hi, self.n))
        lo = np.where(high > (self.last >> self.width), self.n, lo)
        hi = np.maximum(hi, lo)
        past = hi.copy()
        low = targets & _U((1 << self.width) - 1)
        while True:  # binary search among values with the same high part: a few at most, as a rule
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            less = self.lows(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        same = lo < past
        same[same] = self.lows(lo[same]) == low[same]
        return lo, same


class Level:
    """One trie level: contexts, monotone pointers to their successors, successors, quantised log probabilities.

    Successors of a context are ascending; each is stored plus the last stored
    value of the context before, so that the whole level is one monotone
    sequence, and a search is relative to its context's start.
    """

    def __init__(self, buffer):
        view = memoryview(buffer)
        self.contexts = EliasFano(view)
        view = view[self.contexts.size :]
        self.pointers = EliasFano(view)
        view = view[self.pointers.size :]
        self.successors = EliasFano(view)
        view = view[self.successors.size :]
        self.book = np.frombuffer(view, "<f4", 256)
        self.codes = np.frombuffer(view, np.uint8, self.successors.n, 1024)

    @staticmethod
    def encode(context: np.ndarray, successor: np.ndarray, logp: np.ndarray) -> bytes:
        """From rows sorted by (context, successor), without repeats."""
        n = len(context)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if n else np.zeros(0, np.int64)
        span = np.diff(np.concatenate([first, [n]]))
        largest = successor[first + span - 1].astype(np.uint64) if n else np.zeros(0, np.uint64)
        base = np.concatenate([[0], np.cumsum(largest + _U(1), dtype=np.uint64)[:-1]]).astype(np.uint64) if n else largest
        stored = successor.astype(np.uint64) + np.repeat(base, span)
        codes, book = quantised(logp)
        parts = (context[first] if n else largest, np.concatenate([first, [n]]), stored)
        return b"".join([*map(EliasFano.encode, parts), book.astype("<f4").tobytes(), codes.tobytes()])

    def lookup(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, whether the pair is there) for each query."""
        place, found = self.places(context, successor)
        code = np.zeros(len(context), np.uint8)
        code[found] = self.codes[place[found]]
        return code, found

    def places(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the level, whether the pair is there) for each query."""
        found, out = np.zeros(len(context), bool), np.zeros(len(context), np.int64)
        if not self.successors.n or not len(context):
            return out, found
        new = np.concatenate([[True], context[1:] != context[:-1]])  # queries come in runs of one context
        own = np.cumsum(new) - 1
        at, there = self.contexts.find(context[new].astype(np.uint64))
        at = np.minimum(at, self.contexts.n - 1)
        lo, hi = self.pointers[at].astype(np.int64), self.pointers[at + 1].astype(np.int64)
        base = np.where(lo > 0, self.successors[np.maximum(lo - 1, 0)] + _U(1), _U(0))
        known = np.flatnonzero(there[own])
        place, same = self.successors.find(base[own[known]] + successor[known].astype(np.uint64))
        same &= place < hi[own[known]]
        found[known[same]], out[known[same]] = True, place[same]
        return out, found


def quantised(logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their 256 values, the means of bins: edges half of equal count, half of equal width, so that rare values keep their place too."""
    if not len(logp):
        return np.zeros(0, np.uint8), np.zeros(256, np.float32)
    edges = np.unique(np.concatenate([np.quantile(logp, np.linspace(0, 1, 128)[1:-1]), np.linspace(logp.min(), logp.max(), 131)[1:-1]]))
    codes = np.searchsorted(edges, logp, "right").astype(np.uint8)
    n = np.bincount(codes, minlength=256)
    return codes, (np.bincount(codes, logp, 256) / np.maximum(n, 1)).astype(np.float32)
