"""An FM-index over word symbols: suffix order, wavelet ranks and sampled suffix positions.

Symbols are 1 to ``alphabet``; 0 ends a segment. Segment ends count as distinct, so the order of two
suffixes is decided within their segments.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in their order, by prefix doubling over what is still tied."""
    size = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    bits = int(rank.max()).bit_length() + 1 if size else 1
    length = max(1, 62 // bits)
    padded = np.concatenate([rank + 1, np.zeros(length, dtype=np.int64)])
    key = np.zeros(size, dtype=np.int64)
    for k in range(length):
        key = (key << bits) | padded[k : k + size]
    order = np.argsort(key, kind="stable")
    slots = np.arange(size)
    fresh = np.ones(size, dtype=bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            return order
        at = order[tied]
        after = np.where(at + length < size, rank[np.minimum(at + length, size - 1)] + 1, 0)
        key = rank[at] * (size + 1) + after
        new = np.argsort(key, kind="stable")
        at, key = at[new], key[new]
        order[tied] = at
        fresh = np.ones(size, dtype=bool)
        fresh[tied[1:]] = (key[1:] != key[:-1]) | (np.diff(tied) > 1)
        # The first of a group keeps the group's rank; later ones that differ start a new one.
        start = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[at] = start[tied]
        length *= 2


class Wavelet:
    """Wavelet matrix: ranks and symbols of a sequence, one bit vector per bit of a symbol."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        current = sequence.astype(np.int64)
        symbols = np.arange(alphabet + 1)
        base = np.zeros(alphabet + 1, dtype=np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)])
            blocks = packed.view("<u8")
            self.bits.append(blocks)
            counts = np.zeros(len(blocks) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(blocks), out=counts[1:])
            self.counts.append(counts)
            self.zeros.append(int(len(current) - bit.sum()))
            base = self._step(len(self.bits) - 1, base, (symbols >> level & 1).astype(bool))
            current = np.concatenate([current[~bit], current[bit]])
        self.base = base

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][block] + np.bitwise_count(self.bits[level][block] & below).astype(np.int64)

    def _step(self, level: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        ones = self._ones(level, at)
        return np.where(bit, self.zeros[level] + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        for level in range(self.levels):
            at = self._step(level, at, (symbol >> (self.levels - 1 - level) & 1).astype(bool))
        return at - self.base[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for level in range(self.levels):
            bit = (self.bits[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            symbol = symbol << 1 | bit
            at = self._step(level, at, bit)
        return symbol, at - self.base[symbol]


class FMIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = SAMPLE):
        order = suffix_order(symbols)
        before = np.concatenate([[0], symbols[:-1]]) if len(symbols) else symbols
        last = before[order]
        self.size = len(symbols)
        self.wavelet = Wavelet(last, alphabet)
        self.smaller = np.zeros(alphabet + 2, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=alphabet + 1), out=self.smaller[1:])
        # Positions that follow a segment end are sampled too: no walk crosses an end.
        self.sampled = (order % sample == 0) | (last == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the phrases (one per row, padded on the right), searched backwards."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.flatnonzero((lengths > 0) & (high > 0))
        high[lengths == 0] = 0
        for step in range(int(lengths.max(initial=0))):
            alive = alive[(lengths[alive] > step) & (high[alive] > low[alive])]
            if not len(alive):
                break
            symbol = phrases[alive, lengths[alive] - 1 - step]
            both = self.wavelet.rank(
                np.concatenate([symbol, symbol]), np.concatenate([low[alive], high[alive]])
            ) + self.smaller[np.concatenate([symbol, symbol])]
            low[alive], high[alive] = both[: len(alive)], both[len(alive) :]
        return low, np.maximum(low, high)

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text positions of suffix slots, by walking back to the next sampled position."""
        at, walked = slots.copy(), np.zeros(len(slots), dtype=np.int64)
        open_ = np.flatnonzero(~self.sampled[at]) if len(at) else at
        while len(open_):
            symbol, rank = self.wavelet.access(at[open_])
            at[open_] = self.smaller[symbol] + rank
            walked[open_] += 1
            open_ = open_[~self.sampled[at[open_]]]
        return self.positions[self.sample_rank[at]] + walked
