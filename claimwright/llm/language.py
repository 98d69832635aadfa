"""Language identification in two steps: the language family first, then the language within it.

A text is the square roots of its shares of byte bigrams and trigrams inside words, hashed to
``FEATURES`` buckets and scaled to unit length. Linear support vector machines, fitted by Spark on
labelled rows, tell each family from the others; inside the family they tell every two languages apart
and vote. A family is taken from ``FAMILIES``; languages that it doesn't list are one more family.

Fitting uses at most about ``TRAIN_ROWS`` labelled rows, shared among the languages and drawn by a
hash of the id; prediction covers every row.

Defined cases: a text that is null or has no letters is ``und`` with score 0, in fitting it is left
out; rows with a null id are predicted but never learned from; with one learned language all texts
with letters are that language, with none they are ``und``. Votes that tie are decided by the sum of
margins, then by name. Repeated rows are predicted alike. An empty table gives an empty result. Only
``doc_id``, ``text`` and (for fitting) ``lang`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.text import LOWER, joined, slices
from claimwright.session import settle

FEATURES = 2048
TRAIN_ROWS = 4000
UNKNOWN = "und"
_LETTER = re.compile("[A-Za-z]")

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-iranian": "bn fa gu hi ku mr ne pa ps ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "sino-tibetan": "my zh",
    "austronesian": "id jv ms tl",
    "hellenic": "el",
    "japonic": "ja",
    "koreanic": "ko",
    "tai": "lo th",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(re.split("[-_]", lang.lower())[0], "other")


# Bytes that can be in a word; everything else is a space.
_INSIDE = np.full(256, 0x20, dtype=np.uint8)
_INSIDE[0x61:0x7B] = np.arange(0x61, 0x7B)
_INSIDE[0x80:] = np.arange(0x80, 0x100)


def text_features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text, of unit length or zero."""
    data, offsets = joined(texts)
    count = len(offsets) - 1
    codes = _INSIDE[LOWER[data]].astype(np.uint32)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    total = np.zeros(count * FEATURES)
    for width in (2, 3):
        if len(codes) < width:
            continue
        gram = np.zeros(len(codes) - width + 1, dtype=np.uint32)
        for k in range(width):
            gram = gram << np.uint32(8) | codes[k : len(codes) - width + 1 + k]
        # A gram begins or ends at a word's edge at most; a text ends with a line feed.
        held = codes[1 : len(gram) + 1] != 0x20 if width == 3 else (codes[:-1] != 0x20) | (codes[1:] != 0x20)
        bucket = ((gram + np.uint32(width)) * np.uint32(2654435761)) >> np.uint32(21)
        total += np.bincount(
            owner[: len(gram)][held] * FEATURES + bucket[held], minlength=count * FEATURES
        )
    rows = np.sqrt(total).reshape(count, FEATURES)
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def has_letters(texts: pa.Array) -> np.ndarray:
    found = [
        bool(t) and (_LETTER.search(t) is not None or any(c.isalpha() for c in t))
        for t in texts.to_pylist()
    ]
    return np.array(found, dtype=bool)


@dataclass
class Model:
    """Families with their languages, and a hyperplane for every family and pair of languages."""

    families: dict[str, list[str]]
    planes: dict[tuple, np.ndarray] = field(default_factory=dict)  # weights, then the intercept

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each row of features."""
        names = sorted(self.families)
        if not names or not len(rows):
            return [UNKNOWN] * len(rows), np.zeros(len(rows))
        margin = lambda key: rows @ self.planes[key][:-1] + self.planes[key][-1]
        if len(names) > 1:
            margins = np.stack([margin((f,)) for f in names], axis=1)
        else:
            margins = np.zeros((len(rows), 1))
        chosen = margins.argmax(axis=1)
        odds = np.exp(2 * (margins - margins.max(axis=1, keepdims=True)))
        sure = odds[np.arange(len(rows)), chosen] / odds.sum(axis=1)
        langs = np.empty(len(rows), dtype=object)
        score = np.zeros(len(rows))
        for at, family in enumerate(names):
            own = np.flatnonzero(chosen == at)
            members = self.families[family]
            votes = np.zeros((len(own), len(members)))
            sums, belief = votes.copy(), votes.copy()
            for a, b in combinations(range(len(members)), 2):
                m = (rows[own] @ self.planes[members[a], members[b]][:-1]) + self.planes[members[a], members[b]][-1]
                votes[:, a] += m > 0
                votes[:, b] += m <= 0
                sums[:, a] += m
                sums[:, b] -= m
                belief[:, a] += 1 / (1 + np.exp(-2 * m))
                belief[:, b] += 1 / (1 + np.exp(2 * m))
            ranked = votes + 0.5 * (1 + np.tanh(sums)) * 0.999
            best = ranked.argmax(axis=1)
            langs[own] = np.array(members, dtype=object)[best]
            pairs = max(1, len(members) - 1)
            inner = belief[np.arange(len(own)), best] / pairs if len(members) > 1 else np.ones(len(own))
            score[own] = sure[own] * inner
        return langs.tolist(), np.clip(score, 0, 1)


def _vectors(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``features`` of the rows whose text has letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=256):
            held = has_letters(part.column("text"))
            values = text_features(part.column("text"))[held]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1, dtype=np.int32) * FEATURES), pa.array(values.reshape(-1))
            )
            own = part.filter(pa.array(held))
            yield pa.RecordBatch.from_arrays([*[own.column(k) for k in keep], lists], [*keep, "features"])

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.select(*keep, "text").mapInArrow(run, f"{kinds}, features array<float>")


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS, iterations: int = 30) -> Model:
    """Fit on ``doc_id, text, lang`` rows with a language."""
    rows = labelled.filter("lang is not null and doc_id is not null").select(
        "doc_id", "lang", F.col("text").cast("string").alias("text")
    )
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    families: dict[str, list[str]] = {}
    for lang in sorted(counts):
        families.setdefault(family_of(lang), []).append(lang)
    model = Model(families)
    if len(counts) < 2:
        return model
    share = {lang: min(1.0, train_rows / len(counts) / n) for lang, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1_000_000)) < limit * 1_000_000
    sample = settle(_vectors(rows.filter(drawn), "lang"), "language-sample").select(
        "lang", array_to_vector("features").alias("features")
    )
    sample = sample.persist()
    seen = {r.lang for r in sample.select("lang").distinct().collect()}
    model.families = {f: [x for x in langs if x in seen] for f, langs in families.items()}
    model.families = {f: langs for f, langs in model.families.items() if langs}

    def plane(rows: DataFrame, positive: list[str]) -> np.ndarray:
        labelled = rows.withColumn("label", F.col("lang").isin(positive).cast("double"))
        fitted = LinearSVC(maxIter=iterations, regParam=1e-4, standardization=False).fit(labelled)
        return np.append(fitted.coefficients.toArray(), fitted.intercept)

    if len(model.families) > 1:
        for family, langs in model.families.items():
            model.planes[family,] = plane(sample, langs)
    for langs in model.families.values():
        for a, b in combinations(langs, 2):
            model.planes[a, b] = plane(sample.filter(F.col("lang").isin(a, b)), [a])
    sample.unpersist()
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # planes of all languages, a few MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=256):
            held = has_letters(part.column("text"))
            langs, score = shared.value.predict(text_features(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([x if h else UNKNOWN for x, h in zip(langs, held)], pa.string()),
                    pa.array(np.where(held, score, 0.0)),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
