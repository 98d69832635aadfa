"""Benchmark decontamination with an FM-index per shard of the documents.

Words are lower-cased runs of ASCII letters, digits and characters beyond ASCII. A benchmark item is
searched as all its windows of ``WINDOW`` consecutive words; a shorter item is one window. Each task
indexes its documents shard by shard: words become symbols of the benchmark's vocabulary, other words
end a segment, and segments shorter than the shortest window, which cannot hold one, are left out.
Windows are searched backwards through wavelet-tree ranks, occurrences are located by sampled suffix
positions, and overlapping or adjacent ones are merged to spans.

The benchmark is sent to the tasks in blocks of ``BLOCK_BYTES`` of text. With more than one block the
documents pass the blocks in turn, and the spans and items found so far travel with each row.

Defined cases: null documents and items have no words. Items without words are never found. An item
with a null id is searched but not listed. Repeated items are listed once. Empty tables on either
side give no hits. Words are compared by 64-bit hashes of their bytes. Further columns stay out of
the way: only ``doc_id``, ``text`` and ``item_id`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.fm_index import FMIndex
from claimwright.llm.text import ALNUM, slices, split_words
from claimwright.session import settle

WINDOW = 13
SHARE = 20  # contaminated: at least one in so many words is hit
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 2 << 20

_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


@dataclass
class Phrases:
    """The distinct windows of a block of items, as symbols of the block's vocabulary."""

    vocabulary: np.ndarray  # sorted word hashes; a word's symbol is its index + 1
    windows: np.ndarray  # a row of symbols each, padded with zeros
    lengths: np.ndarray
    owners: np.ndarray  # (window, item) pairs, sorted by window
    ids: np.ndarray

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None], window: int) -> Phrases:
        words = split_words(pa.array(texts, type=pa.string()), ALNUM, lower=True)
        vocabulary, symbols = np.unique(words.hashes(), return_inverse=True)
        rows, owners = {}, set()
        for item in range(len(texts)):
            own = symbols[words.first[item] : words.first[item + 1]] + 1
            width = min(window, len(own))
            for i in range(len(own) - width + 1 if width else 0):
                row = rows.setdefault(tuple(own[i : i + width].tolist()), len(rows))
                owners.add((row, item))
        table = np.zeros((len(rows), window), dtype=np.int64)
        for row, i in rows.items():
            table[i, : len(row)] = row
        return cls(
            vocabulary,
            table,
            (table > 0).sum(axis=1),
            np.array(sorted(owners), dtype=np.int64).reshape(-1, 2),
            np.array([*ids, None], dtype=object)[:-1],
        )


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All slots of the intervals, and the interval of each."""
    size = high - low
    of = np.repeat(np.arange(len(low)), size)
    return low[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), of


def _occurrences(symbols: np.ndarray, limits: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which windows occur, and the windows.

    ``symbols`` has 0 for words outside the vocabulary, ``limits`` marks each text's first word.
    """
    shortest = int(phrases.lengths.min()) if len(phrases.lengths) else 0
    if not shortest or not len(symbols):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    known = symbols > 0
    opens = known & np.concatenate([[True], ~known[:-1]]) | known & limits
    starts = np.flatnonzero(opens)
    stops = known & ~np.concatenate([known[1:] & ~limits[1:], [False]])
    ends = np.flatnonzero(stops) + 1
    long = ends - starts >= shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # Segments one after another, each closed by 0, with the word position of every symbol.
    position, _ = _expand(starts, ends + 1)
    sequence = symbols[np.minimum(position, len(symbols) - 1)]
    sequence[np.cumsum(ends + 1 - starts) - 1] = 0
    index = FMIndex(sequence, len(phrases.vocabulary))
    low, high = index.search(phrases.windows, phrases.lengths)
    slots, window = _expand(low, high)
    return position[index.locate(slots)], window


def find(texts: pa.Array, earlier: list[list[dict]], phrases: Phrases) -> tuple[np.ndarray, pa.Array, list[set]]:
    """Word counts, merged hit spans with ``earlier`` ones, and item numbers of each text."""
    words = split_words(texts, ALNUM, lower=True)
    count = len(words.start)
    hashes = words.hashes()
    symbols = np.zeros(count, dtype=np.int64)
    if len(phrases.vocabulary):
        at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
        symbols = np.where(phrases.vocabulary[at] == hashes, at + 1, 0)
    limits = np.zeros(count, dtype=bool)
    limits[words.first[:-1][words.first[:-1] < count]] = True
    places, window = _occurrences(symbols, limits, phrases)
    hit = np.zeros(count + 1, dtype=np.int64)
    np.add.at(hit, places, 1)
    np.add.at(hit, places + phrases.lengths[window], -1)
    for text, spans in enumerate(earlier):
        for span in spans or ():
            hit[words.first[text] + span["first"]] += 1
            hit[words.first[text] + span["last"]] -= 1
    inside = np.cumsum(hit)[:-1] > 0
    opens = inside & (np.concatenate([[True], ~inside[:-1]]) | limits) if count else inside
    first = np.flatnonzero(opens)
    closes = inside & ~np.concatenate([inside[1:] & ~limits[1:], [False]]) if count else inside
    last = np.flatnonzero(closes) + 1
    text_of = np.searchsorted(words.first, first, side="right") - 1
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    begins = _text_begins(texts)
    spans = pa.StructArray.from_arrays(
        [
            pa.array(first - words.first[text_of]),
            pa.array(last - words.first[text_of]),
            pa.array(chars[words.start[first]] - chars[begins[text_of]]),
            pa.array(chars[words.end[last - 1]] - chars[begins[text_of]]),
        ],
        fields=list(_SPAN),
    )
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
    items: list[set] = [set() for _ in range(len(texts))]
    owner_text = np.searchsorted(words.first, places, side="right") - 1
    pairs = np.unique(np.stack([owner_text, window], axis=1), axis=0) if len(places) else np.zeros((0, 2), int)
    begin = np.searchsorted(phrases.owners[:, 0], pairs[:, 1], side="left")
    end = np.searchsorted(phrases.owners[:, 0], pairs[:, 1], side="right")
    for (text, _), a, b in zip(pairs.tolist(), begin.tolist(), end.tolist()):
        items[text].update(phrases.owners[a:b, 1].tolist())
    return np.diff(words.first), pa.ListArray.from_arrays(pa.array(offsets), spans), items


def _text_begins(texts: pa.Array) -> np.ndarray:
    lengths = [len(t) + 1 if t is not None else 1 for t in texts.cast(pa.large_binary()).to_pylist()]
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for block in range(count):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else items
        rows = own.dropDuplicates().collect()
        yield [r.item_id for r in rows], [r.text for r in rows]


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents, the ``text`` beside a struct ``row`` of the rest, with ``n_words``, the hit ``spans`` and the ``items``.

    A span has its first and last word (exclusive) and its start and end in code points.
    """
    context = docs.sparkSession.sparkContext
    names = docs.columns
    frame = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names if n != "text"]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.expr("0L").alias("n_words"),
        F.expr("cast(array() as array<struct<first:long,last:long,start:long,end:long>>)").alias("spans"),
        F.expr("cast(array() as array<long>)").alias("items"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in frame.schema])
    for number, (ids, texts) in enumerate(_blocks(benchmark, block_bytes)):
        phrases = context.broadcast(Phrases.of(ids, texts, window))

        def run(batches: Iterator[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            sought = phrases.value
            for part in slices(batches, "text", SHARD_BYTES):
                n_words, spans, items = find(part.column("text"), part.column("spans").to_pylist(), sought)
                listed = [
                    sorted({*(old or ()), *(int(sought.ids[i]) for i in new if sought.ids[i] is not None)})
                    for old, new in zip(part.column("items").to_pylist(), items)
                ]
                columns = [
                    part.column("row"),
                    part.column("text"),
                    pa.array(n_words.astype(np.int64)),
                    spans,
                    pa.array(listed, type=pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        frame = (settle(frame, "scanned") if number else frame).mapInArrow(run, schema)
    return frame


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, contaminated`` per document.

    Contaminated: a word is hit, and at least one in ``share`` words.
    """
    found = scan(docs.select("doc_id", "text"), benchmark, window)
    return found.select("row.doc_id", "n_words", _hit().alias("n_hit"), "spans", "items", _verdict(share).alias("contaminated"))


def _hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def _verdict(share: int):
    return (_hit() > 0) & (share * _hit() >= F.col("n_words"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """The documents that are not contaminated, unchanged, with all their columns."""
    kept = scan(docs, benchmark, window).filter(~_verdict(share))
    return kept.select(*[_column(n) for n in docs.columns])


def _column(name: str):
    return F.col("text") if name == "text" else F.col("row").getField(name).alias(name)


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with every hit span cut out of the text; all other columns stay."""
    kept = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda state, s: F.struct(
            F.concat(
                state["text"],
                F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
            ).alias("text"),
            s["end"].alias("at"),
        ),
    )
    found = scan(docs, benchmark, window).withColumn("kept", kept)
    rest = F.concat(
        F.col("kept.text"),
        F.substring(F.col("text"), (F.col("kept.at") + 1).cast("int"), F.char_length("text")),
    )
    text = F.when(F.size("spans") > 0, rest).otherwise(F.col("text"))
    return found.select(
        *[text.alias(n) if n == "text" else _column(n) for n in docs.columns]
    )
