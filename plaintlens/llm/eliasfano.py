"""Elias-Fano sequences and the two-level trie made of them, in numpy arrays that may lie in a mapped file."""

from __future__ import annotations

from pathlib import Path

import numpy as np

#: Bits that share one entry of the directory of the unary part.
BLOCK = 256
#: Queries answered at once.
CHUNK = 1 << 15


class EliasFano:
    """A non-decreasing sequence of unsigned numbers.

    The low bits of each value are packed side by side. The high parts are a bitmap: for each high value
    in turn, a one for every element that has it, then a zero. `parts` holds all data as plain arrays.
    """

    def __init__(self, parts: dict[str, np.ndarray]) -> None:
        self.n, self.width = int(parts["shape"][0]), int(parts["shape"][1])
        self.low, self.bits, self.ones = parts["low"], parts["bits"], parts["ones"]
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * BLOCK - self.ones

    @staticmethod
    def parts(values: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays of a sequence."""
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * width) // 64 + 2, np.uint64)
        if width:
            kept = values & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, kept << shift)
            over = np.flatnonzero(shift + np.uint64(width) > 64)
            np.bitwise_or.at(low, word[over] + 1, kept[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(width)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        unary = np.zeros(-(-size // BLOCK) * BLOCK, np.uint8)
        unary[high + np.arange(n)] = 1
        ones = np.concatenate([[0], np.cumsum(unary.reshape(-1, BLOCK).sum(1, dtype=np.int64))[:-1]])
        return {"shape": np.array([n, width], np.int64), "low": low, "bits": np.packbits(unary, bitorder="little"), "ones": ones}

    def _select(self, rank: np.ndarray, zeros: bool) -> np.ndarray:
        """Position of the bit with this rank (from 0) among the ones or zeros."""
        before = self.zeros if zeros else self.ones
        block = np.searchsorted(before, rank, "right") - 1
        left = rank - before[block]
        lines = self.bits.reshape(-1, BLOCK // 8)[block]
        if zeros:
            lines = ~lines
        counts = np.cumsum(np.bitwise_count(lines), 1, dtype=np.int64)
        byte = (counts <= left[:, None]).sum(1)
        row = np.arange(len(rank))
        left = left - np.where(byte > 0, counts[row, np.maximum(byte - 1, 0)], 0)
        inside = np.cumsum((lines[row, byte][:, None] >> np.arange(8, dtype=np.uint8)) & 1, 1)
        return block * BLOCK + byte * 8 + (inside <= left[:, None]).sum(1)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        spill = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | spill) & np.uint64((1 << self.width) - 1)

    def get(self, index: np.ndarray) -> np.ndarray:
        """Elements by index."""
        out = np.empty(len(index), np.uint64)
        for first in range(0, len(index), CHUNK):
            part = index[first : first + CHUNK]
            high = (self._select(part, False) - part).astype(np.uint64)
            out[first : first + CHUNK] = (high << np.uint64(self.width)) | self._low(part)
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1: the successor of the value, if it equals it.

        The unary part bounds the elements with the same high part; a binary search of their low bits follows.
        """
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        top = self._select(np.array([self.n - 1]), False)[0] - (self.n - 1)
        for first in range(0, len(values), CHUNK):
            value = values[first : first + CHUNK]
            high = (value >> np.uint64(self.width)).astype(np.int64)
            inside = np.flatnonzero(high <= top)
            high, low = high[inside], value[inside] & np.uint64((1 << self.width) - 1)
            start = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) + 1 - high, 0)
            end = self._select(high, True) - high
            begin, stop = start.copy(), end.copy()
            while (open_ := np.flatnonzero(begin < stop)).size:
                middle = (begin[open_] + stop[open_]) >> 1
                less = self._low(middle) < low[open_]
                begin[open_] = np.where(less, middle + 1, begin[open_])
                stop[open_] = np.where(less, stop[open_], middle)
            there = begin < end
            there[there] = self._low(begin[there]) == low[there]
            out[first + inside[there]] = begin[there]
        return out


#: Bits of a context within its word's contexts.
CONTEXT = 40


class Trie:
    """Words, and below each word the contexts it was seen after.

    Level one holds the words, their counts (as running sums) and pointers into level two, level two the
    contexts of each word relative to it (the word's index in the high bits makes them monotone)
    and one byte for each: the code of its smoothed weight in a book of 256.
    """

    LEVELS = ("words", "counts", "pointers", "contexts")

    def __init__(self, folder: Path) -> None:
        """Map a saved trie's levels into memory."""
        self.levels = {}
        for name in self.LEVELS:
            self.levels[name] = EliasFano({part: np.load(folder / f"{name}-{part}.npy", mmap_mode="r") for part in ("shape", "low", "bits", "ones")})
        self.codes = np.load(folder / "codes.npy", mmap_mode="r")
        self.book = np.load(folder / "book.npy")

    @classmethod
    def save(cls, folder: Path, words: np.ndarray, counts: np.ndarray, parents: np.ndarray, contexts: np.ndarray, weights: np.ndarray) -> None:
        """Write a trie: sorted words with counts; contexts (with parents, the index of their word) sorted within each word."""
        ends = np.cumsum(np.bincount(parents, minlength=len(words))).astype(np.uint64)
        below = (parents.astype(np.uint64) << np.uint64(CONTEXT)) | contexts
        for name, values in zip(cls.LEVELS, (words, np.cumsum(counts).astype(np.uint64), ends, below), strict=True):
            for part, data in EliasFano.parts(values).items():
                np.save(folder / f"{name}-{part}.npy", data)
        # half of the codes follow the weights, half their range, so that no rare large weight is far from its code
        spread = np.linspace(0, 1, 129)[1:-1]
        edges = np.unique([*np.quantile(weights, spread), *(weights.min() + spread * np.ptp(weights))]) if len(weights) else np.zeros(0)
        codes = np.searchsorted(edges, weights).astype(np.uint8)
        sums, n = np.bincount(codes, weights, 256), np.bincount(codes, minlength=256)
        np.save(folder / "codes.npy", codes)
        np.save(folder / "book.npy", sums / np.maximum(n, 1))

    def counts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (or -1) and count of each word."""
        index = self.levels["words"].find(words)
        found = index >= 0
        count = np.zeros(len(words), np.int64)
        upto = self.levels["counts"].get(index[found]).astype(np.int64)
        later = index[found] > 0
        upto[later] -= self.levels["counts"].get(index[found][later] - 1).astype(np.int64)
        count[found] = upto
        return index, count

    def weights(self, index: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Weight of each context below the word with this index; nan where it was not seen."""
        out = np.full(len(index), np.nan)
        known = np.flatnonzero(index >= 0)
        at = self.levels["contexts"].find((index[known].astype(np.uint64) << np.uint64(CONTEXT)) | contexts[known])
        out[known[at >= 0]] = self.book[self.codes[at[at >= 0]]]
        return out
