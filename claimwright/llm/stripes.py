"""Associative next-word counters keyed by prefixes, as arrays.

A block of stripes is four arrays: the prefixes, one row of longs each, where each one's stripe ends,
and the next words with their counts. Merging adds counts element by element. Words are 64-bit hashes;
the first long of a prefix is its language's.
"""

from __future__ import annotations

import numpy as np

from claimwright.llm.text import mix64

# Next words of a one-word prefix are dealt to so many blocks, as common words have long stripes.
SPREAD = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of equally long columns, whose order matters."""
    total = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        total = total * _STEP + column
    return mix64(total)


def added(columns: list[np.ndarray], counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of ``columns`` once, with the sum of their counts (None: one each)."""
    if not len(columns[0]):
        return columns, np.zeros(0, dtype=np.int64)
    key = gram_hash(columns)
    order = np.argsort(key)
    columns, key = [c[order] for c in columns], key[order]
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    differs = np.zeros(len(key), dtype=bool)
    for c in columns:
        differs[1:] |= c[1:] != c[:-1]
    if (differs & ~opens).any():  # two different rows share a hash: compare the rows themselves
        again = np.lexsort(columns[::-1])
        order, columns = order[again], [c[again] for c in columns]
        opens = np.zeros(len(key), dtype=bool)
        opens[0] = True
        for c in columns:
            opens[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(opens)
    if counts is None:
        sums = np.diff(np.append(at, len(key)))
    else:
        sums = np.add.reduceat(counts[order], at)
    return [c[at] for c in columns], sums.astype(np.int64)


class Stripes:
    """Counts of word sequences, merged whenever more than ``most`` entries have come together.

    Where more than half of that is distinct, the next merge waits until the entries have doubled.
    """

    def __init__(self, width: int, most: int):
        self.width, self.most, self.limit = width, most, most
        self.parts: list = []
        self.size = 0

    def add(self, columns: list[np.ndarray], counts: np.ndarray | None = None) -> None:
        columns, counts = added(columns, counts)
        self.parts.append((columns, counts))
        self.size += len(counts)
        if self.size > self.limit:
            self._merge()
            self.limit = max(self.most, 2 * self.size)

    def _merge(self) -> None:
        if len(self.parts) > 1:
            columns = [np.concatenate([p[0][i] for p in self.parts]) for i in range(self.width)]
            self.parts = [added(columns, np.concatenate([p[1] for p in self.parts]))]
            self.size = len(self.parts[0][1])

    @property
    def full(self) -> bool:
        """Whether even the merged counts are more than half of what may be held."""
        return self.size > self.most // 2

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All counts; nothing is left."""
        self._merge()
        found = self.parts[0] if self.parts else ([np.zeros(0, np.uint64)] * self.width, np.zeros(0, np.int64))
        self.parts, self.size, self.limit = [], 0, self.most
        return found


def blocks(columns: list[np.ndarray], counts: np.ndarray, buckets: int) -> list[tuple]:
    """``(bucket, prefixes, ends, next, counts)`` of the counted rows, a block per bucket."""
    prefix = gram_hash(columns[:-1])
    dealt = prefix + (columns[-1] % np.uint64(SPREAD) if len(columns) == 3 else np.uint64(0))
    bucket = mix64(dealt) % np.uint64(buckets)
    order = np.lexsort([columns[-1], *columns[-2::-1], bucket])
    columns, counts, bucket = [c[order] for c in columns], counts[order], bucket[order]
    opens = np.zeros(len(counts), dtype=bool)
    opens[:1] = True
    for c in [bucket, *columns[:-1]]:
        opens[1:] |= c[1:] != c[:-1]
    firsts = np.flatnonzero(opens)
    lasts = np.append(firsts[1:], len(counts))
    prefixes = np.stack([c[firsts] for c in columns[:-1]], axis=1) if len(firsts) else np.zeros((0, 1), np.uint64)
    cuts = np.flatnonzero(np.diff(bucket[firsts], prepend=bucket[:1] + np.uint64(1))) if len(firsts) else firsts
    found = []
    for a, b in zip(cuts, np.append(cuts[1:], len(firsts))):
        begin, end = firsts[a], lasts[b - 1]
        found.append(
            (int(bucket[begin]), prefixes[a:b].ravel(), lasts[a:b] - begin, columns[-1][begin:end], counts[begin:end])
        )
    return found


def unpacked(prefixes: np.ndarray, ends: np.ndarray, following: np.ndarray) -> list[np.ndarray]:
    """The columns of a block: those of the prefixes, repeated for each next word, and the next words."""
    rows = prefixes.reshape(len(ends), -1)
    lengths = np.diff(ends, prepend=0)
    return [*[np.repeat(rows[:, i], lengths) for i in range(rows.shape[1])], following]


class Sieve:
    """A bitmap of hashes: what is not in it was not put in. Its size is fixed."""

    def __init__(self, bits: int, at: np.ndarray, words: np.ndarray):
        self.mask = np.uint64(bits - 1)
        self.words = np.zeros(bits >> 6, dtype=np.uint64)
        self.words[at] = words

    @staticmethod
    def entries(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and bits that ``hashes`` set."""
        place = hashes & np.uint64(bits - 1)
        order = np.argsort(place)
        place = place[order]
        at, first = np.unique(place >> np.uint64(6), return_index=True)
        bit = np.uint64(1) << (place & np.uint64(63))
        return at.astype(np.int64), np.bitwise_or.reduceat(bit, first) if len(first) else bit

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        word = self.words[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) == 1
