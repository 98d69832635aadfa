"""Toxicity of texts, scored on what disguised words stand for.

Texts are restored first (``deobfuscate``). Words and the first four, five and six bytes of longer
words are features, hashed to ``FEATURES`` buckets; a text has a feature or not. From labelled rows the
``SELECTED`` features with the strongest evidence are kept, and Spark fits a logistic regression on them.

Fitting uses at most about ``TRAIN_ROWS`` labelled rows, half of them of each label where there are as
many, drawn by a hash of the id; the character model counts all documents; scoring covers all rows.

Defined cases: a null or empty text has the score of a text without features; labels that are null and
labels of ids without documents are ignored; an id with several labels takes part with each; without
rows of both labels all scores are the share of toxic labels (0 without labels). Repeated rows have the
same score. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.deobfuscate import CharModel, char_model, restorer
from claimwright.llm.text import ALNUM, mix64, powers, slices, split_words
from claimwright.session import settle

FEATURES = 1 << 20
SELECTED = 512
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
_PREFIXES = (4, 5, 6)
_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def text_features(texts: pa.Array, restore) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and features, each pair once, sorted."""
    restored = pa.array([restore(t) if t else "" for t in texts.to_pylist()], pa.string())
    words = split_words(restored, ALNUM, lower=True)
    size = len(words.data)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_VALUES[words.data] * powers(_BASE, size + 1)[:size], out=sums[1:])
    inverse = powers(_INVERSE, size + 1)
    length, owner = words.end - words.start, words.text_of
    found = []
    for width in (0, *_PREFIXES):
        held = length > width
        start = words.start[held]
        end = words.end[held] if width == 0 else start + width
        value = mix64((sums[end] - sums[start]) * inverse[start] + np.uint64(width))
        found.append(owner[held].astype(np.int64) * FEATURES + (value >> np.uint64(44)).astype(np.int64))
    pairs = np.unique(np.concatenate(found))
    return pairs // FEATURES, pairs % FEATURES


@dataclass
class Model:
    chars: CharModel
    selected: np.ndarray  # sorted features
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array, restore) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        if len(self.selected):
            text, feature = text_features(texts, restore)
            at = np.minimum(np.searchsorted(self.selected, feature), len(self.selected) - 1)
            held = self.selected[at] == feature
            np.add.at(total, text[held], self.weights[at[held]])
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _sample(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """``toxic, text`` of the drawn labelled rows."""
    known = labels.filter("toxic is not null and doc_id is not null").select("doc_id", "toxic")
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, train_rows / 2 / n))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1_000_000))
    if counts:
        known = known.filter(drawn < share[F.col("toxic")] * 1_000_000)
    # About train_rows rows of two numbers: bounded by the parameter.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return settle(texts.join(F.broadcast(known), "doc_id").select("toxic", "text"), "toxicity-sample")


def _evidence(sample: DataFrame, chars) -> DataFrame:
    """``feature, toxic, n``: how many sampled texts of each label have a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = restorer(chars.value)
        counts: dict[int, np.ndarray] = {}
        for part in slices(batches):
            label = part.column("toxic").to_numpy(zero_copy_only=False)
            text, feature = text_features(part.column("text"), restore)
            for toxic in (0, 1):
                own = np.bincount(feature[label[text] == toxic], minlength=FEATURES)
                counts[toxic] = counts.get(toxic, 0) + own
        for toxic, own in counts.items():
            at = np.flatnonzero(own)
            for a in range(0, len(at), 100_000):
                some = at[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.full(len(some), toxic, dtype=np.int32)), pa.array(own[some])],
                    ["feature", "toxic", "n"],
                )

    return sample.mapInArrow(run, "feature long, toxic int, n long")


def _presence(sample: DataFrame, chars, selected: np.ndarray) -> DataFrame:
    """``label, features`` with a 0 or 1 per selected feature."""
    width = len(selected)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = restorer(chars.value)
        for part in slices(batches, rows=1000):
            text, feature = text_features(part.column("text"), restore)
            at = np.minimum(np.searchsorted(selected, feature), width - 1)
            held = selected[at] == feature
            rows = np.zeros((part.num_rows, width), dtype=np.float32)
            rows[text[held], at[held]] = 1
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1))
            )
            label = pa.array(part.column("toxic").to_numpy(zero_copy_only=False).astype(np.float64))
            yield pa.RecordBatch.from_arrays([label, lists], ["label", "features"])

    return sample.mapInArrow(run, "label double, features array<float>")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, selected: int = SELECTED) -> Model:
    """Fit on ``labels`` (doc_id, toxic); the character model is of all ``docs``."""
    context = docs.sparkSession.sparkContext
    chars = char_model(docs)
    shared = context.broadcast(chars)  # two fixed arrays, 2.6 MB
    sample = _sample(docs, labels, train_rows)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    empty = Model(chars, np.zeros(0, dtype=np.int64), np.zeros(0), 0.0)
    if not toxic or not clean:
        empty.intercept = 50.0 if toxic else -50.0
        return empty
    counts = (
        _evidence(sample, shared)
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
        )
    )
    # G squared of the feature against the label; features of toxic texts only.
    p, q = F.col("a") / toxic, F.col("b") / clean
    both = (F.col("a") + F.col("b")) / (toxic + clean)
    term = lambda n, x, y: F.when(n > 0, n * F.log(x / y)).otherwise(0.0)
    gain = (
        term(F.col("a"), p, both)
        + term(F.col("b"), q, both)
        + term(toxic - F.col("a"), 1 - p, 1 - both)
        + term(clean - F.col("b"), 1 - q, 1 - both)
    )
    best = (
        counts.filter((p > 2 * q) & (F.col("a") >= 3))
        .select("feature", gain.alias("gain"))
        .orderBy(F.desc("gain"), "feature")
        .limit(selected)
        .collect()
    )
    features = np.array(sorted(r.feature for r in best), dtype=np.int64)
    if not len(features):
        empty.intercept = float(np.log(toxic / clean))
        return empty
    rows = settle(_presence(sample, shared, features), "toxicity-features").select(
        "label", array_to_vector("features").alias("features")
    )
    # Both labels weigh the same, however few toxic texts there are.
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, clean / toxic).otherwise(1.0)).persist()
    fitted = LogisticRegression(
        maxIter=50, regParam=1e-4, standardization=False, weightCol="weight"
    ).fit(rows)
    rows.unpersist()
    return Model(chars, features, fitted.coefficients.toArray(), float(fitted.intercept))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = restorer(shared.value.chars)
        for part in slices(batches):
            values = shared.value.scores(part.column("text"), restore)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def restored(docs: DataFrame, chars: CharModel) -> DataFrame:
    """``doc_id`` and the lower-cased, restored ``text`` of every row."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = restorer(shared.value)
        for part in slices(batches):
            texts = [None if t is None else restore(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string")
