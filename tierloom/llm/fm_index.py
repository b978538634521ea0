"""A compressed full-text index over words: suffix order, last column in a wavelet matrix, backward search for many patterns."""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with the count of ones before each 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        """Ones among the first ``upto`` bits, for each of many positions."""
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Symbols in a wavelet matrix: one row of bits for each binary digit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.first = [], np.zeros(size, np.int64)
        names = np.arange(size)
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            digit = (symbols >> shift) & 1
            bits, zeros = Bits(digit.astype(np.uint8)), int(len(digit) - digit.sum())
            self.levels.append((shift, bits, zeros))
            symbols = np.concatenate([symbols[digit == 0], symbols[digit == 1]])
            self.first = self._down(self.first, (names >> shift) & 1, bits, zeros)

    @staticmethod
    def _down(at, digit, bits, zeros):
        ones = bits.ones(at)
        return np.where(digit == 1, zeros + ones, at - ones)

    def count(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first ``upto``."""
        at = upto
        for shift, bits, zeros in self.levels:
            at = self._down(at, (symbols >> shift) & 1, bits, zeros)
        return at - self.first[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; every 0 ends a string and counts as a character of its own, in the order of place."""
    ends = np.flatnonzero(text == 0)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    width, n = 1, len(text)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, bool)
        fresh[0], fresh[1:] = True, np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        width *= 2


class FMIndex:
    """Index over strings of symbols 1 to ``size - 1``, each followed by 0."""

    def __init__(self, text: np.ndarray, size: int):
        order = suffix_order(text)
        self.last = Wavelet(text[order - 1], size)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.length = len(text)

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put a symbol in front of each pattern: the range of suffixes that begin with the longer pattern."""
        both = self.last.count(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        both += np.tile(self.starts[symbols], 2)
        return both[: len(symbols)], both[len(symbols) :]


def repeated_stretches(index: FMIndex, text: np.ndarray, begins: np.ndarray, lengths: np.ndarray, least: int) -> tuple:
    """Matching statistics of strings that are in the index themselves: stretches that occur at least twice.

    Returns ``owner, begin, end`` of stretches of at least ``least`` symbols, which together cover every place where that many
    symbols in a row occur again. All strings are searched side by side, from their ends: a stretch grows to the left while two
    or more suffixes begin with it. When it can't grow, no longer stretch with this end is repeated, and the search goes on
    with the next end that a stretch reaching further left can have.
    """
    owner = np.flatnonzero(lengths >= least)
    end = lengths[owner].copy()
    at, low, high = end.copy(), np.zeros(len(owner), np.int64), np.full(len(owner), index.length)
    found: list[tuple] = []
    while len(owner):
        new_low, new_high = index.step(text[begins[owner] + at - 1], low, high)
        grows = new_high - new_low >= 2
        at = at - grows
        low, high = np.where(grows, new_low, low), np.where(grows, new_high, high)
        done = ~grows | (at == 0)
        if done.any():
            report = done & (end - at >= least)
            found.append((owner[report], at[report], end[report]))
            end = np.where(done, np.minimum(end - 1, at - 1 + least), end)
            stays = ~(done & ((at == 0) | (end < least)))
            at = np.where(done, end, at)
            low, high = np.where(done, 0, low), np.where(done, index.length, high)
            owner, end, at, low, high = (x[stays] for x in (owner, end, at, low, high))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))
