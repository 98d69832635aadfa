"""Whole texts as arrays of bytes, words and word hashes inside one task.

Texts are taken from Arrow batches in slices of about a megabyte (a longer text is a slice of its
own), so a task's memory follows its longest text and not its number of rows. Words are maximal
runs of word bytes; a word class that is closed over UTF-8 continuation bytes can be tested per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20

# Words without white space: everything but space and \t \n \v \f \r.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# Words of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix64(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first ``count`` powers of an odd base modulo 2^64, kept for the next slice."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        values = np.full(count, base, dtype=np.uint64)
        values[0] = 1
        known = _powers[base] = np.multiply.accumulate(values)
        if count > 8 * SLICE_BYTES:  # one very long text: not worth keeping
            del _powers[base]
    return known[:count]


@dataclass
class Words:
    """The words of several texts. ``first[d]:first[d + 1]`` are the words of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = len(self.data)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * powers(_BASE, size + 1)[:size], out=sums[1:])
        content = (sums[self.end] - sums[self.start]) * powers(_BASE_INVERSE, size + 1)[self.start]
        return mix64(content ^ (self.end - self.start).astype(np.uint64))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by a line feed, and their offsets. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    empty, closing = (pa.scalar(v, pa.large_string()) for v in ("", "\n"))
    closed = pc.binary_join_element_wise(texts, empty, closing)
    if isinstance(closed, pa.ChunkedArray):
        closed = closed.combine_chunks()
    _, offsets, data = closed.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[closed.offset : closed.offset + len(closed) + 1]
    if data is None or len(closed) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(closed) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def split_words(texts: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Words:
    data, offsets = joined(texts)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = word_bytes[data]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[0::2], edges[1::2]
    return Words(data, start, end, np.searchsorted(start, offsets))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` hashes, in order; runs may cross texts."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(_BASE) + hashes[k : k + count]
    return mix64(total)


def runs_of(first: np.ndarray, width: int) -> np.ndarray:
    """Whether the run of ``width`` words that begins at each word stays in its text."""
    count = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(count)
    return left >= width


def slices(
    batches: Iterator[pa.RecordBatch],
    column: str = "text",
    limit: int = SLICE_BYTES,
    rows: int = 10_000,
) -> Iterator[pa.RecordBatch]:
    """Cut batches into ranges of at most ``rows`` rows whose texts have about ``limit`` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(lengths.astype(np.int64) + 1)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            stop = min(stop, begin + rows)
            yield batch.slice(begin, stop - begin)
            begin = stop


_BATCH = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}


@contextmanager
def small_batches(spark: SparkSession):
    """While a table is written: batches of a few megabytes between Spark and its Python workers."""
    before = {key: spark.conf.get(key) for key in _BATCH}
    for key, value in _BATCH.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
