"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Fingerprints
at most ``max_bits`` apart are linked, and linked fingerprints form components.

Links are found by multi-index hashing. A fingerprint is cut into so many segments that two linked
ones differ by at most one bit in some segment. Every fingerprint looks up the small Hamming ball
around each of its segments in a table of all segments, and each match is verified on all 64 bits.
A pair of values one bit apart needs one lookup only, so balls hold the value itself and those with
a set bit cleared. A segment value shared by more than ``BUCKET`` fingerprints is not a table entry;
its fingerprints look up their whole ball instead, by equality, which finds the same links without
comparing the members of the bucket with each other. The lookups are many times the fingerprints, so
neither side of such a join is broadcast.

Defined cases: a null text has no words; a text without words has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle. Repeated rows are copies. A
null id takes part but is never a component's id, unless all ids of the component are null. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.graph import components
from claimwright.llm.text import slices
from claimwright.session import settle, unbroadcast

SHINGLE, MAX_BITS, SEED = 3, 2, 42
# Fingerprints that may share a table entry; the links of fuller ones are found by equality.
BUCKET = 64
_BITS = 64


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # on bytes: ASCII letters and the six ASCII spaces only
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = [0, *ends[:-1].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist())]


def _majority(texts: list[bytes], shingle: int) -> np.ndarray:
    hashes = [np.array(shingle_hashes(t, shingle), dtype=np.uint64) for t in texts]
    prints = np.zeros(len(texts), dtype=np.uint64)
    weights = np.uint64(1) << np.arange(_BITS, dtype=np.uint64)
    for i, own in enumerate(hashes):
        if len(own):
            counts = np.zeros(_BITS, dtype=np.int64)
            for part in range(0, len(own), 1 << 16):
                octets = own[part : part + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            prints[i] = weights[counts * 2 > len(own)].sum(dtype=np.uint64)
    return prints


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row ``(doc_id, fingerprint)`` per document; the fingerprint is 64 bits in a long."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
            prints = _majority(texts, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(prints)], ["doc_id", "fingerprint"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint long")


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def _segments(max_bits: int) -> list[int]:
    """Bit masks of so many segments that one differs by at most one bit."""
    count = max_bits // 2 + 1
    cuts = [round(i * _BITS / count) for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _ball(max_bits: int) -> list[int]:
    """All patterns of one to ``max_bits`` bits."""
    return [
        _signed(sum(1 << b for b in chosen))
        for size in range(1, max_bits + 1)
        for chosen in combinations(range(_BITS), size)
    ]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the fingerprints in ``distinct`` at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    own = distinct.select("fingerprint")
    masks = _segments(max_bits)
    radius = 1 if max_bits else 0
    keyed = own.select(
        "fingerprint",
        F.posexplode(
            F.array(*[F.col("fingerprint").bitwiseAND(F.lit(_signed(m))) for m in masks])
        ).alias("segment", "value"),
    )
    size = keyed.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("members"))
    full = settle(size.filter(F.col("members") > bucket), "full-buckets")
    table = keyed.join(full, ["segment", "value"], "left_anti").select(
        "segment", "value", F.col("fingerprint").alias("other")
    )
    near = F.array(
        *[
            F.array(F.lit(0), *[F.lit(_signed(1 << b)) for b in range(_BITS) if radius and m >> b & 1])
            for m in masks
        ]
    )
    probes = keyed.select(
        "fingerprint",
        "segment",
        F.col("value").alias("held"),
        F.explode(
            F.filter(near[F.col("segment")], lambda bit: F.col("value").bitwiseAND(bit) == bit)
        ).alias("bit"),
    ).select("fingerprint", "segment", F.col("held").bitwiseXOR(F.col("bit")).alias("value"))
    fits = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= max_bits
    found = (
        unbroadcast(probes).join(table, ["segment", "value"])
        .filter((F.col("fingerprint") != F.col("other")) & fits)
        .select("fingerprint", "other")
    )
    if not full.isEmpty() and max_bits:
        crowded = keyed.join(full, ["segment", "value"], "left_semi").select("fingerprint").distinct()
        whole = crowded.select(
            "fingerprint", F.explode(F.array(*[F.lit(p) for p in _ball(max_bits)])).alias("bits")
        ).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("bits")).alias("other"))
        found = found.unionByName(
            whole.join(unbroadcast(own.withColumnRenamed("fingerprint", "other")), "other", "left_semi")
        )
    return found.select(
        F.least("fingerprint", "other").alias("a"), F.greatest("fingerprint", "other").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row; the fingerprint in 16 hex digits.

    ``component_id`` is the smallest doc_id of all documents that links reach.
    """
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    groups = settle(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")), "distinct-prints"
    )
    roots = components(settle(links(groups, max_bits, bucket), "links"))
    roots = unbroadcast(roots.withColumnRenamed("node", "fingerprint"))
    rooted = groups.join(roots, "fingerprint", "left").select(
        "fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(unbroadcast(least), "root").select("fingerprint", "component_id")
    return prints.join(unbroadcast(named), "fingerprint", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET
) -> DataFrame:
    """The documents without near duplicates: of each component the one with the smallest id.

    All columns stay. Rows with a null id come last, rows with equal ids in the order of a hash of
    the row, and of wholly equal rows one stays.
    """
    identity = F.struct(
        F.col("doc_id").isNull().alias("absent"),
        F.col("doc_id").alias("id"),
        F.xxhash64(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"),
    )
    marked = near_duplicates(docs.select(identity.alias("doc_id"), "text"), shingle, max_bits, bucket)
    kept = settle(
        marked.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")),
        "kept",
    )
    rows = docs.select(
        identity.alias("doc_id"), F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row")
    )
    once = rows.join(unbroadcast(kept.filter("n = 1")), "doc_id", "left_semi").select("row.*")
    repeated = kept.filter("n > 1")
    if repeated.isEmpty():
        return once
    return once.unionByName(
        rows.join(unbroadcast(repeated), "doc_id", "left_semi").select("row.*").dropDuplicates()
    )
