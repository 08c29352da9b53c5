"""Monotone sequences in Elias-Fano form, read from one memory-mapped buffer, many queries at a time."""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QQQQ")  # values, low bits, words of the low part, words of the high part
BLOCK = 8  # 64-bit words of the high part that a directory entry covers


def _words(bits: int) -> int:
    return (bits + 63) // 64 + 1  # one more: a field may be read across a word's end


class EliasFano:
    """n non-decreasing values: `low` bits of each packed, the rest in unary with a rank directory."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64).reshape(-1, BLOCK)
        # The directories are made when a buffer is opened: one count a block, 1/16 of the high part.
        self.ones = np.concatenate(([0], np.cumsum(ones.sum(axis=1))))
        self.zeros = np.arange(len(self.ones)) * (BLOCK * 64) - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, int(top // max(1, n)).bit_length() - 1)
        low = np.zeros(_words(n * low_bits), np.uint64)
        if low_bits and n:
            part = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(low_bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = (int(place[-1]) if n else 0) + 2
        high = np.zeros(-(-size // (64 * BLOCK)) * BLOCK, np.uint64)
        np.bitwise_or.at(high, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        return cls(n, low_bits, low, high)

    def write(self) -> bytes:
        return HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def read(cls, data: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at a byte of a buffer (a view, nothing is copied), and where it ends."""
        n, bits, low, high = HEAD.unpack(data[at : at + HEAD.size].tobytes())
        at += HEAD.size
        parts = [data[at : at + 8 * low].view(np.uint64), data[at + 8 * low : at + 8 * (low + high)].view(np.uint64)]
        return cls(n, bits, *parts), at + 8 * (low + high)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Places of the k-th (from 0) one or zero of the high part."""
        directory = self.ones if ones else self.zeros
        block = np.searchsorted(directory, k, side="right") - 1
        rest = k - directory[block]
        words = self.high.reshape(-1, BLOCK)[block]
        if not ones:
            words = ~words
        upto = np.cumsum(np.bitwise_count(words).astype(np.int64), axis=1)
        word = (upto <= rest[:, None]).sum(axis=1)
        row = np.arange(len(k))
        rest -= np.where(word > 0, upto[row, np.maximum(word - 1, 0)], 0)
        value = words[row, np.minimum(word, BLOCK - 1)]
        place = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word by its count of ones
            half = value & np.uint64((1 << width) - 1)
            count = np.bitwise_count(half).astype(np.int64)
            up = rest >= count
            rest -= np.where(up, count, 0)
            place += np.where(up, width, 0)
            value = np.where(up, value >> np.uint64(width), half)
        return (block * BLOCK + word) * 64 + place

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.low_bits) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        i = np.asarray(i, np.int64)
        high = self._select(i, True) - i
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place whose value is at least x, and whether it equals x."""
        x = np.asarray(x, np.uint64)
        place = np.full(len(x), self.n, np.int64)
        found = np.zeros(len(x), bool)
        if not self.n:
            return place, found
        top = self.at(np.array([self.n - 1]))[0]
        ask = np.flatnonzero(x <= top)
        part = (x[ask] >> np.uint64(self.low_bits)).astype(np.int64)
        low = x[ask] & np.uint64((1 << self.low_bits) - 1)
        # Values with the same high part stand between two zeros: their places follow.
        bound = lambda h: np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
        start, end = bound(part), bound(part + 1)
        while True:  # halving: low parts ascend inside a run
            open_ = start < end
            if not open_.any():
                break
            middle = (start + end) // 2
            less = np.zeros(len(ask), bool)
            less[open_] = self._low(middle[open_]) < low[open_]
            start = np.where(open_ & less, middle + 1, start)
            end = np.where(open_ & ~less, middle, end)
        place[ask] = start
        ok = start < self.n
        found[ask[ok]] = self.at(start[ok]) == x[ask[ok]]
        return place, found
