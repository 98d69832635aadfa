"""Repeated passages by sparse suffix arrays.

Words are lower-cased runs of letters, digits and characters beyond ASCII. Of every ``MIN_WORDS``
consecutive words, the suffix is retained that begins at the least of the eight-word hashes in their
first ``reach`` words, so equal passages retain equal suffixes wherever they stand, and about two in
``reach`` positions are kept. A retained suffix is known by the hash of its first ``core`` =
``MIN_WORDS`` - ``reach`` + 1 words: two equal passages of ``MIN_WORDS`` words share a whole core.

1. Suffixes whose core occurs once are dropped, by a combinable count.
2. Suffixes that agree in the ``reach`` - 1 words after the core and in as many before it, too, are a
   class, known by one hash. A class with two members matches wherever its words are enough.
3. Cores of several classes are looked at further. One member of each of their classes gets its
   contexts: three-byte hashes of the words after the core and before it, nearest first. The classes
   are sorted by core, then by what follows, and neighbours are compared: a match is extended to the
   right and to the left as far as the contexts agree, and counts from ``MIN_WORDS`` words on. A second
   order sorts by what precedes. Every match of neighbours is a link of their classes.
4. Neighbours can hide a match behind a third class that agrees on one side only. This takes a pair of
   neighbours without a match in both orders of the core, and classes whose longest extensions together
   reach ``MIN_WORDS``: those are looked up by all their windows of ``MIN_WORDS`` words, so nothing is lost.

Sorting is by core and the first word of the context that is sorted on, so a core that a third of all
documents share is spread by its surroundings, and equal surroundings are one class. Suffixes that
differ in both words next to the core share fewer than ``MIN_WORDS`` words.

Results are merged spans of words per document. Spans that share ``MIN_WORDS`` words, directly or over
other spans, have one ``component``: components are formed over classes, from the matches of step 3 and 4
and from classes of one span, so copies cost one node. ``partner`` is one document
that shares the span's first passage; all others are those of the component.

Defined cases: null texts and texts of fewer than ``MIN_WORDS`` words have no spans; a passage that
repeats inside a document counts; repeated rows repeat each other; a null id stays null. An empty table
gives an empty result. Further columns are ignored. Words and runs are compared by 64-bit hashes, the
ends of spans by 24-bit hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.llm.graph import components
from claimwright.llm.text import (
    ALNUM,
    Words,
    mix64,
    powers,
    runs_of,
    slices,
    small_batches,
    split_words,
)
from claimwright.session import salted_left_join, settle

MIN_WORDS = 50
REACH = 34
GRAM = 8
HOT_CLASS = 20_000  # rows of a class from which on its joins are salted
_CODE = 3  # bytes of a word in a context
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Spans:
    """Hashes of any runs of words, from running sums."""

    def __init__(self, hashes: np.ndarray):
        size = len(hashes) + 1
        self.sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(hashes * powers(_BASE, size)[:-1], out=self.sums[1:])
        self.inverse = powers(_INVERSE, size)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.inverse[start])


def retained(words: Words, spans: _Spans, min_words: int, reach: int, gram: int) -> np.ndarray:
    """Positions of the retained suffixes: the least gram of each window, leftmost if equal."""
    count = len(words.start)
    starts = np.flatnonzero(runs_of(words.first, min_words)) if count else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return starts
    grams = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    places = np.arange(count - gram + 1)
    grams[places] = spans.of(places, places + gram)
    best, at = grams[starts], starts.copy()
    for step in range(1, reach):
        other = grams[starts + step]
        less = other < best
        best = np.where(less, other, best)
        at[less] = starts[less] + step
    return np.unique(at)


def _identity() -> Column:
    return F.struct(
        F.col("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    )


def sparse_suffixes(docs: DataFrame, min_words: int, reach: int, gram: int = GRAM) -> DataFrame:
    """Retained suffixes: ``doc``, word position ``at``, hashes of their ``core`` and ``class``.

    ``on_left`` and ``on_right`` count the words of the class before and after the core.
    """
    core, width = min_words - reach + 1, reach - 1
    rows = docs.select(_identity().alias("doc"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"), ALNUM, lower=True)
            spans = _Spans(words.hashes())
            at = retained(words, spans, min_words, reach, gram)
            text = np.searchsorted(words.first, at, side="right") - 1
            begin = np.maximum(at - width, words.first[text])
            end = np.minimum(at + core + width, words.first[text + 1])
            lengths = ((at - begin) << 32 | (end - at)).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc").take(pa.array(text)),
                    pa.array((at - words.first[text]).astype(np.int32)),
                    pa.array(spans.of(at, at + core).view(np.int64)),
                    pa.array(mix64(spans.of(begin, end) ^ mix64(lengths)).view(np.int64)),
                    pa.array((at - begin).astype(np.int32)),
                    pa.array((end - at - core).astype(np.int32)),
                ],
                ["doc", "at", "core", "class", "on_left", "on_right"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc {kind}, at int, core long, class long, on_left int, on_right int"
    )


def _contexts(docs: DataFrame, wanted: DataFrame, min_words: int, reach: int) -> DataFrame:
    """``wanted`` (doc, at, core, class) with the coded words behind and before their cores."""
    core = min_words - reach + 1
    width = reach - 1
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("at", "core", "class")).alias("suffixes"))
    rows = docs.select(_identity().alias("doc"), F.col("text").cast("string").alias("text")).join(lists, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"), ALNUM, lower=True)
            codes = (words.hashes() >> np.uint64(40)).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - _CODE :]
            suffixes = part.column("suffixes")
            text = np.repeat(np.arange(part.num_rows), suffixes.value_lengths().to_numpy())
            flat = suffixes.flatten()
            at = flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
            place = words.first[text] + at
            right = _coded(codes, place + core, np.minimum(place + core + width, words.first[text + 1]))
            back = codes[::-1]
            left = _coded(back, len(codes) - place, len(codes) - np.maximum(place - width, words.first[text]))
            for a in range(0, len(at), 4000):
                b = min(len(at), a + 4000)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(text[a:b])),
                        flat.field("core").slice(a, b - a),
                        flat.field("class").slice(a, b - a),
                        pa.array(right[a:b], pa.binary()),
                        pa.array(left[a:b], pa.binary()),
                    ],
                    ["doc", "core", "class", "right", "left"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, core long, class long, right binary, left binary")


def _coded(codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(codes).tobytes()
    return [raw[_CODE * a : _CODE * b] for a, b in zip(start.tolist(), stop.tolist())]


def common_words(a: bytes, b: bytes) -> int:
    """How many coded words two contexts share from their beginning."""
    size = min(len(a), len(b)) // _CODE
    if a[: size * _CODE] == b[: size * _CODE]:
        return size
    low, high = 0, size
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * _CODE] == b[: middle * _CODE]:
            low = middle
        else:
            high = middle
    return low


def _neighbours(classes: DataFrame, first: str, second: str) -> DataFrame:
    """Compare each class with the next one in the order of core, ``first``, ``second``.

    One row per pair of neighbours of a core, with the words that both extensions share; ``apart`` if
    they share a word on the sorted side but too few on both sides together to match.
    """
    word = F.substring(F.col(first), 1, _CODE)
    dealt = classes.repartition("core", word).sortWithinPartitions("core", first, second, "class")
    kind = classes.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            doc = batch.schema.field("doc").type
            kinds = pa.schema(
                [("core", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("doc_a", doc), ("doc_b", doc)]
                + [("on_left", pa.int32()), ("on_right", pa.int32())]
            )
            out = []
            for own in batch.to_pylist():
                if held is not None and held["core"] == own["core"]:
                    left = common_words(held["left"], own["left"])
                    right = common_words(held["right"], own["right"])
                    pair = (own["core"], held["class"], own["class"], held["doc"], own["doc"], left, right)
                    out.append(dict(zip(kinds.names, pair)))
                held = own
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    rows = dealt.select("class", "core", "doc", "right", "left").mapInArrow(
        run, f"core long, a long, b long, doc_a {kind}, doc_b {kind}, on_left int, on_right int"
    )
    return rows.withColumn("order", F.lit(first))


def _by_windows(classes: DataFrame, open_: DataFrame, reach: int) -> DataFrame:
    """Exact matches of the classes that neighbours have left open, by windows of ``min_words`` words.

    ``least`` is the least class that holds the window.
    """
    width = reach - 1
    rows = classes.join(open_.select("class"), "class", "left_semi")
    windows = rows.select(
        "class", "core", "doc", "left", "right", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("back")
    ).filter(
        (F.octet_length("left") >= F.col("back") * _CODE)
        & (F.octet_length("right") >= (width - F.col("back")) * _CODE)
    )
    keyed = windows.select(
        "class",
        "core",
        "doc",
        "back",
        F.xxhash64(
            F.substring("left", F.lit(1), F.col("back") * _CODE),
            F.substring("right", F.lit(1), (width - F.col("back")) * _CODE),
        ).alias("window"),
    )
    key = ["core", "back", "window"]
    groups = keyed.groupBy(*key).agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("class").alias("least"), F.count(F.lit(1)).alias("n")
    )
    return (
        keyed.join(groups.filter("n > 1").drop("n"), key)
        .select(
            "class",
            F.when(F.col("doc") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("partner"),
            F.col("back").cast("int").alias("on_left"),
            (width - F.col("back")).cast("int").alias("on_right"),
            "least",
        )
    )


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """``doc_id, text_hash, first, last, partner, component``: merged word spans that occur elsewhere too.

    Every passage of ``min_words`` words or more that occurs twice is inside a span, and every word of
    a span is in such a passage. ``partner`` is a document that shares a passage of the span, and spans
    have the same ``component`` exactly if a chain of shared passages leads from one to the other.
    """
    if not GRAM <= min_words - reach + 1 <= min_words:
        raise ValueError("the core must hold a gram")
    core_words, width = min_words - reach + 1, reach - 1
    spark = docs.sparkSession
    with small_batches(spark):
        suffixes = settle(sparse_suffixes(docs, min_words, reach), "suffixes")
    # Stored, so that the join below is one of two tables and its hot cores can be split.
    counts = suffixes.groupBy("core").agg(F.count(F.lit(1)).alias("n"))
    twice = settle(counts.filter("n > 1").select("core"), "cores")
    found = settle(suffixes.join(twice, "core", "left_semi"), "repeated-cores")
    classes = settle(
        found.groupBy("class", "core", "on_left", "on_right").agg(
            F.min(F.struct("doc", "at")).alias("rep"),
            F.max("doc").alias("other"),
            F.count(F.lit(1)).alias("n"),
        ),
        "classes",
    )
    members = classes.filter("n > 1").filter(
        F.col("on_left") + F.col("on_right") + core_words >= min_words
    ).select("class", "other", F.col("rep.doc").alias("doc"), "on_left", "on_right")
    several = classes.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    wanted = classes.join(several, "core", "left_semi").select("rep.doc", "rep.at", "core", "class")
    with small_batches(spark):
        heavy = settle(_contexts(docs, wanted, min_words, reach), "contexts")
    pairs = settle(
        _neighbours(heavy, "right", "left").unionByName(_neighbours(heavy, "left", "right")),
        "neighbours",
    )
    reaches = F.col("on_left") + F.col("on_right") >= width
    near = F.when(F.col("order") == "right", F.col("on_right")).otherwise(F.col("on_left"))
    extents = pairs.select("core", F.col("a").alias("class"), F.col("doc_b").alias("partner"), "on_left", "on_right")
    extents = extents.unionByName(
        pairs.select("core", F.col("b").alias("class"), F.col("doc_a").alias("partner"), "on_left", "on_right")
    )
    # Where every pair of neighbours that share a word matches, in one order, the matches are complete.
    apart = (
        pairs.filter(~reaches & (near > 0)).groupBy("core").agg(F.count_distinct("order").alias("orders"))
        .filter("orders = 2").select("core")
    )
    open_ = (
        extents.groupBy("class", "core")
        .agg(F.max("on_left").alias("best_left"), F.max("on_right").alias("best_right"))
        .filter(F.col("best_left") + F.col("best_right") >= width)
        .join(apart, "core", "left_semi")
    )
    exact = settle(_by_windows(heavy, open_, reach), "windows")
    whole = members.select("class", F.col("other").alias("partner"), "on_left", "on_right")
    whole = whole.unionByName(members.select("class", F.col("doc").alias("partner"), "on_left", "on_right"))
    matches = extents.filter(reaches).drop("core").unionByName(whole).unionByName(exact.drop("least"))
    # One row per class: where all its matches together reach, and two partners to choose from.
    reach_of = matches.groupBy("class").agg(
        F.max("on_left").alias("on_left"),
        F.max("on_right").alias("on_right"),
        F.min("partner").alias("low"),
        F.max("partner").alias("high"),
    )
    reach_of = settle(reach_of, "reach")
    # A class may hold a third of all rows: hot ones are salted.
    spans = (
        salted_left_join(found.select("class", "doc", "at"), reach_of, ["class"], hot_rows=HOT_CLASS)
        .filter("on_left is not null")
        .select(
            "doc",
            "class",
            (F.col("at") - F.col("on_left")).alias("first"),
            (F.col("at") + core_words + F.col("on_right")).alias("last"),
            F.when(F.col("doc") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("partner"),
        )
    )
    # A document's spans: as many as it has suffixes at most. Those that overlap or touch are one.
    in_order = Window.partitionBy("doc").orderBy("first", "last", "class")
    until = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    placed = spans.withColumn("_until", until)
    placed = placed.withColumn("_opens", F.col("_until").isNull() | (F.col("first") > F.col("_until")))
    placed = placed.withColumn("_island", F.count_if("_opens").over(in_order))
    # Each class of a span is linked to the span's least: a chain of them would take rounds by its length.
    least = F.min("class").over(Window.partitionBy("doc", "_island"))
    placed = settle(placed.withColumn("_least", least), "placed")
    links = (
        placed.filter("class <> _least").select(F.col("class").alias("a"), F.col("_least").alias("b"))
        .unionByName(pairs.filter(reaches).select("a", "b"))
        .unionByName(exact.select(F.col("class").alias("a"), F.col("least").alias("b")))
    )
    roots = settle(components(links).select(F.col("node").alias("class"), "root"), "components")
    merged = placed.groupBy("doc", "_island").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min(F.struct("first", "partner"))["partner"].alias("partner"),
        F.min("_least").alias("class"),
    )
    return salted_left_join(settle(merged, "spans"), roots, ["class"], hot_rows=HOT_CLASS).select(
        "doc.doc_id",
        "doc.text_hash",
        "first",
        "last",
        F.col("partner.doc_id").alias("partner"),
        F.coalesce("root", "class").alias("component"),
    )
