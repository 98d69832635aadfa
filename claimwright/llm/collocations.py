"""Phrase collocations by the stripes pattern.

Each prefix of words keys an associative counter of its next words. Tasks count whole slices of texts
into stripes, deal them out by a hash of the prefix and merge them element by element. Stripes give the
counts of the extensions, those of shorter prefixes give the totals of a phrase's parts, and the
largest counter of a prefix says whether an extension subsumes it.

Orders follow each other: the stripes of n words take only sequences whose first and last n - 1 words
are frequent, as no other can be. A fixed-size bitmap of the frequent ones (``SIEVE_BITS``) tells it in
the tasks; what it lets through wrongly is counted and dropped. Stripes of the empty prefix, the
vocabulary, are kept as one row a word, and those of one word are dealt to ``SPREAD`` blocks by the next
word, so a very frequent word is not one task's work.

The lowest score of a phrase over its cuts is floor(2000000 a / (l + r)) with a, l and r the counts of
the phrase and of both parts, in exact decimals. A phrase goes if a phrase one word longer contains it
with at least 80 % of its count; a still longer one that does so contains such a one.

Defined cases: a null text is empty, a null language is ``und``. Upper case A to Z is lowered. Words
are sequences without spaces and tabs in pieces without ``.,;:!?`` and line ends; they are compared by
64-bit hashes, and two frequent words with one hash are an error. Repeated rows count again. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.llm.stripes import Sieve, Stripes, blocks, gram_hash, unpacked
from claimwright.llm.text import slices, small_batches, split_words
from claimwright.session import settle

LEAST, LONGEST, TOP = 30, 4, 2000
# A phrase goes if a longer one has this percentage of its occurrences.
SUBSUMED = 80
SLICE_BYTES = 2 << 20
SIEVE_BITS = 1 << 27
# Entries that a task holds, and words of the corpus a bucket.
HELD = 1 << 20
BUCKET_WORDS = 1 << 20
_SALTS = 64

_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_SEPARATES
_WORD[[0x20, 0x09]] = False


def _lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


class _Slice:
    """The words of a slice of texts with their languages and pieces."""

    def __init__(self, part: pa.RecordBatch):
        self.words = split_words(part.column("text"), _WORD, lower=True)
        self.hash = self.words.hashes()
        langs = part.column("lang").to_pylist()
        known = {lang: _lang_hash(lang) for lang in set(langs)}
        of_text = np.array([known[lang] for lang in langs], dtype=np.uint64)
        self.names = {h: lang for lang, h in known.items()}
        self.lang = of_text[self.words.text_of]
        self.piece = np.cumsum(_SEPARATES[self.words.data])[self.words.start]  # texts end with a separator

    def whole(self, length: int) -> np.ndarray:
        """Whether the sequence of so many words from each word on lies in one piece."""
        count = max(0, len(self.piece) - length + 1)
        return self.piece[:count] == self.piece[length - 1 :][:count]

    def sequence(self, at: np.ndarray, length: int) -> list[np.ndarray]:
        return [self.lang[at], *[self.hash[at + k] for k in range(length)]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """``lang, lang_hash, word, hash, f`` of every word: the stripes of the empty prefix."""
    schema = pa.schema(
        [("lang", pa.string()), ("lang_hash", pa.int64()), ("word", pa.string()), ("hash", pa.int64()), ("f", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            own = _Slice(part)
            key = gram_hash([own.lang, own.hash])
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            data = own.words.data.tobytes()
            spans = zip(own.words.start[first].tolist(), own.words.end[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own.names[h] for h in own.lang[first].tolist()], pa.string()),
                    pa.array(own.lang[first].view(np.int64)),
                    pa.array([data[a:b].decode() for a, b in spans], pa.string()),
                    pa.array(own.hash[first].view(np.int64)),
                    pa.array(counts.astype(np.int64)),
                ],
                schema=schema,
            )

    counted = _texts(docs).mapInArrow(run, "lang string, lang_hash long, word string, hash long, f long")
    with small_batches(docs.sparkSession):
        return settle(counted.groupBy("lang", "lang_hash", "word", "hash").agg(F.sum("f").alias("f")), "vocabulary")


def _sieve(grams: DataFrame, bits: int):
    """The broadcast bitmap of ``grams(lang_hash, gram)``; at most ``bits`` / 64 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lang = batch.column("lang_hash").to_numpy().view(np.uint64)
                words = batch.column("gram").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
                at, bit = Sieve.entries(gram_hash([lang, *words.T]), bits)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], ["at", "bits"])

    found = grams.select("lang_hash", "gram").mapInArrow(run, "at long, bits long")
    table = found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    sieve = Sieve(bits, table.column("at").to_numpy(), table.column("bits").to_numpy().view(np.uint64))
    return grams.sparkSession.sparkContext.broadcast(sieve)


def _count(docs: DataFrame, length: int, sieve, buckets: int) -> DataFrame:
    """Blocks of the stripes of ``length`` words, from sequences whose both shorter parts are in the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = Stripes(length + 1, HELD), sieve.value
        for part in slices(batches, "text", SLICE_BYTES):
            own = _Slice(part)
            shorter = np.arange(max(0, len(own.hash) - length + 2))
            frequent = own.whole(length - 1) & known.has(gram_hash(own.sequence(shorter, length - 1)))
            inside = own.whole(length)
            at = np.flatnonzero(inside & frequent[: len(inside)] & frequent[1:][: len(inside)])
            held.add(own.sequence(at, length))
            if held.full:
                yield _packed(blocks(*held.take(), buckets))
        yield _packed(blocks(*held.take(), buckets))

    return _texts(docs).mapInArrow(
        run, "bucket int, prefixes array<long>, ends array<long>, next array<long>, counts array<long>"
    )


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    lists = [
        pa.array([r[i].view(np.int64) for r in rows], pa.list_(pa.int64())) for i in range(1, 5)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), *lists], ["bucket", "prefixes", "ends", "next", "counts"]
    )


def _merged(batches: Iterator[pa.RecordBatch], length: int, least: int) -> Iterator[pa.RecordBatch]:
    """Merged stripes of blocks that come sorted by bucket; no more than one bucket is held."""
    held, current = Stripes(length + 1, HELD), None
    for batch in batches:
        columns = [batch.column(n) for n in ("prefixes", "ends", "next", "counts")]
        for i, bucket in enumerate(batch.column("bucket").to_pylist()):
            if bucket != current:
                yield from _often(held, least)
                current = bucket
            prefixes, ends, following, counts = (c[i].values.to_numpy() for c in columns)
            held.add(unpacked(prefixes.view(np.uint64), ends, following.view(np.uint64)), counts)
    yield from _often(held, least)


def _often(held: Stripes, least: int) -> Iterator[pa.RecordBatch]:
    """What ``held`` has counted ``least`` times; nothing is left in it."""
    found, counts = held.take()
    often = counts >= least
    for _, prefixes, ends, following, counts in blocks([c[often] for c in found], counts[often], 1):
        if not len(ends):
            continue
        rows = prefixes.reshape(len(ends), -1).view(np.int64)
        begins = np.concatenate([[0], ends])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[:, 0]),
                pa.array(list(rows[:, 1:]), pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(following.view(np.int64))),
                pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(counts)),
                pa.array(np.maximum.reduceat(counts, begins[:-1])),
            ],
            ["lang_hash", "prefix", "next", "counts", "most"],
        )


def _merge(counted: DataFrame, length: int, least: int) -> DataFrame:
    """``lang_hash, prefix, next, counts, most`` of the merged stripes, with what occurs ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(batches, length, least)

    # Sorted, so that a task into which several buckets are put holds one of them at a time.
    dealt = counted.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "lang_hash long, prefix array<long>, next array<long>, counts array<long>, most long")


def _extensions(stripes: DataFrame) -> DataFrame:
    """``lang_hash, gram, f`` of each entry of the stripes."""
    entry = F.inline(F.arrays_zip("next", "counts"))
    return stripes.select("lang_hash", "prefix", entry).select(
        "lang_hash", F.concat("prefix", F.array("next")).alias("gram"), F.col("counts").alias("f")
    )


def stripes(
    docs: DataFrame, words: DataFrame, least: int = LEAST, longest: int = LONGEST, sieve_bits: int = SIEVE_BITS
) -> list[DataFrame]:
    """Stored stripes of two to ``longest`` words, in this order. ``words`` is the vocabulary."""
    spark = docs.sparkSession
    total = words.agg(F.sum("f")).collect()[0][0] or 0
    buckets = max(64, total // BUCKET_WORDS)
    grams = words.filter(F.col("f") >= least).select("lang_hash", F.array("hash").alias("gram"))
    found = []
    for length in range(2, longest + 1):
        sieve = _sieve(grams, sieve_bits)
        with small_batches(spark):
            merged = settle(_merge(_count(docs, length, sieve, buckets), length, least), f"stripes-{length}")
        sieve.destroy()
        found.append(merged)
        grams = _extensions(merged)
    return found


def _part(first: Column | int, length: Column | int) -> Column:
    return F.slice("gram", first, length)


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """The lowest score over all cuts of each candidate, and the counts ``l`` and ``r`` of that cut."""
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    for name, part in (("l", _part(F.lit(1), F.col("k"))), ("r", _part(F.col("k") + 1, F.size("gram") - F.col("k")))):
        sides = counts.select("lang_hash", F.col("gram").alias("_part"), F.col("f").alias(name))
        cuts = cuts.withColumn("_part", part).join(sides, ["lang_hash", "_part"]).drop("_part")
    score = F.expr("CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        cuts.groupBy("lang_hash", "gram", "a").agg(lowest.alias("cut")).select("lang_hash", "gram", "a", "cut.l", "cut.r", "cut.score")
    )


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int | None = TOP,
    subsumed: int = SUBSUMED,
    sieve_bits: int = SIEVE_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language (None: all).

    Order: score and count descending, then phrase in the order of its bytes.
    """
    words = vocabulary(docs)
    frequent = settle(words.filter(F.col("f") >= least), "frequent-words")
    twins = frequent.groupBy("lang_hash", "hash").count().filter("count > 1")
    if not twins.isEmpty():
        raise ValueError("two frequent words of a language have the same 64-bit hash")
    orders = stripes(docs, words, least, longest, sieve_bits)
    grams = [_extensions(s) for s in orders]
    candidates = grams[0]
    for more in grams[1:]:
        candidates = candidates.unionByName(more)
    counts = candidates.unionByName(frequent.select("lang_hash", F.array("hash").alias("gram"), "f"))
    # The largest count of a phrase one word longer: by stripes for the next word, by suffix for the one before.
    longer = None
    for own, extended in zip(orders[1:], grams[1:]):
        after = own.select("lang_hash", F.col("prefix").alias("gram"), F.col("most").alias("_most"))
        before = extended.select("lang_hash", _part(F.lit(2), F.size("gram") - 1).alias("gram"), F.col("f").alias("_most"))
        both = after.unionByName(before)
        longer = both if longer is None else longer.unionByName(both)
    kept = candidates.withColumnRenamed("f", "a")
    if longer is not None:
        most = longer.groupBy("lang_hash", "gram").agg(F.max("_most").alias("_most"))
        share = F.expr(f"CAST(100 AS DECIMAL(10,0)) * CAST(_most AS DECIMAL(20,0)) >= CAST({subsumed} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))")
        kept = kept.join(most, ["lang_hash", "gram"], "left").filter(F.col("_most").isNull() | ~share).drop("_most")
    scored = settle(_scored(kept, counts), "scored")
    order = [F.desc("score"), F.desc("a")]
    if top is not None:  # rows that can be among the first; ties are decided by the phrase
        salted = Window.partitionBy("lang_hash", "_salt").orderBy(*order)
        ranked = Window.partitionBy("lang_hash").orderBy(*order)
        salt = F.pmod(F.xxhash64("gram"), F.lit(_SALTS))
        few = scored.withColumn("_salt", salt).withColumn("_rank", F.rank().over(salted)).filter(F.col("_rank") <= top)
        scored = few.withColumn("_rank", F.rank().over(ranked)).filter(F.col("_rank") <= top).drop("_rank", "_salt")
    spelled = (
        scored.select("*", F.posexplode("gram").alias("_at", "hash"))
        .join(frequent.select("lang_hash", "hash", "word"), ["lang_hash", "hash"])
        .groupBy("lang_hash", "gram", "a", "l", "r", "score")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
        .withColumn("phrase", F.array_join("_words.word", " "))
    )
    place = F.row_number().over(Window.partitionBy("lang_hash").orderBy(*order, "phrase"))
    totals = words.groupBy("lang", "lang_hash").agg(F.sum("f").alias("n"))
    placed = spelled.withColumn("rank", place.cast("long"))
    placed = placed if top is None else placed.filter(F.col("rank") <= top)
    return placed.join(totals, "lang_hash").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
