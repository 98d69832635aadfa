"""Logistic regressions of all folds and regularisations at once, in passes over one stored table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A model is done when no part of its mean gradient, on scaled features, is larger than this.
TOLERANCE = 1e-6


def _summed(rows: DataFrame, size: int, sums) -> np.ndarray:
    """The ``size`` numbers that ``sums`` makes of a batch of rows, added up over all batches by Spark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            values = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]
            if batch.num_rows:
                total += sums(np.column_stack(values[:-2]), values[-2], values[-1])
        cells = np.arange(size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total)], ["cell", "value"])

    cells = rows.mapInArrow(task, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for row in cells.collect():
        out[row.cell] = row.value
    return out


def _moments(rows: DataFrame, features: Sequence[str]) -> list[tuple[int, float, float, np.ndarray, np.ndarray]]:
    """Fold, rows, ones among the labels, means and sums of squares about them, per fold."""
    moments = [F.array(F.avg(c).cast("double"), F.var_pop(c)) for c in features]
    missing = [F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in [*features, "label"]]
    found = rows.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("label").alias("ones"),
        F.count_if(~F.col("label").isin(0.0, 1.0)).alias("others"),
        F.array(*moments).alias("moments"),
        F.array(*missing).alias("missing"),
    )
    out = []
    for row in found.collect():  # a row per fold
        if any(row.missing) or row.others:
            raise ValueError("features must be numbers, and labels 0 or 1")
        pairs = np.array(row.moments, dtype=float)
        out.append((row["_fold"], row.n, row.ones, pairs[:, 0], pairs[:, 1] * row.n))
    return out


def _joined(parts: list[tuple]) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Rows, ones, means and sample deviations of several folds together."""
    n, ones = sum(p[1] for p in parts), sum(p[2] for p in parts)
    mean = sum(p[1] * p[3] for p in parts) / n
    squares = sum(p[4] + p[1] * (p[3] - mean) ** 2 for p in parts)
    deviation = np.sqrt(squares / max(n - 1, 1))
    return n, ones, mean, np.where(deviation > 1e-12 * (1 + abs(mean)), deviation, 0.0)


def judge_folds(
    rows: DataFrame, features: Sequence[str], folds: int, regularisations: Sequence[float], iterations: int
) -> list[tuple[float, int, int, float | None]]:
    """``(regularisation, fold, claims, accuracy)``: each fold judged by the model of all other rows.

    ``rows`` is a stored table of the features, ``label`` (0 or 1) and ``_fold``. Features are scaled with the
    statistics of the rows that a model is fitted on. All models take a step in each pass: a model's gradient
    is of its own rows, its curvature that of all rows at the mean of the folds' models, so that few passes
    are needed and the limit is the exact optimum. A step that does not lower the loss is halved.
    """
    rows = rows.filter("_fold IS NOT NULL").select(*features, "label", F.col("_fold").cast("double").alias("_fold"))
    parts = _moments(rows, features)
    _, _, centre, spread = _joined(parts)
    spread = np.where(spread > 0, spread, 1.0)
    width, strengths = len(features) + 1, [float(s) for s in regularisations]
    models = [(s, held) for s in range(len(strengths)) for held in range(folds)]
    count, held_out = len(models), np.array([held for _, held in models], dtype=float)
    to_fold, rows_of, beta, fixed = [], np.ones(count), np.zeros((count, width)), np.zeros(count, dtype=bool)
    for m, (_, held) in enumerate(models):
        n, ones, mean, deviation = _joined([p for p in parts if p[0] != held])
        inverse = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        change = np.diag(np.append(spread * inverse, 1.0))  # from the common scale to the model's own
        change[:-1, -1] = (centre - mean) * inverse
        to_fold.append(change)
        rows_of[m] = n
        if ones in (0, n):  # one label only
            beta[m, -1], fixed[m] = (50.0 if ones else -50.0), True
    shape = [(count, width), (count,), (count,), (count,), (len(strengths), width, width)]
    ends = np.cumsum([int(np.prod(s)) for s in shape])

    def evaluate(weights: np.ndarray) -> list[np.ndarray]:
        centres = np.array([weights[[m for m, (t, _) in enumerate(models) if t == s]].mean(0) for s in range(len(strengths))])

        def sums(x: np.ndarray, label: np.ndarray, fold: np.ndarray) -> np.ndarray:
            x = np.column_stack([(x - centre) / spread, np.ones(len(x))])
            score, y = x @ weights.T, label[:, None]
            own = fold[:, None] != held_out
            rest = (1.0 / (1.0 + np.exp(-np.clip(score, -500, 500))) - y) * own
            loss = ((np.logaddexp(0.0, score) - y * score) * own).sum(0)
            right = (((score > 0) == (y > 0.5)) & ~own).sum(0)
            curves = []
            for c in centres:
                p = 1.0 / (1.0 + np.exp(-np.clip(x @ c, -500, 500)))
                curves.append((x * (p * (1 - p))[:, None]).T @ x)
            return np.concatenate([(rest.T @ x).ravel(), loss, right, (~own).sum(0), np.array(curves).ravel()])

        flat = _summed(rows, int(ends[-1]), sums)
        return [part.reshape(s) for part, s in zip(np.split(flat, ends[:-1]), shape)]

    everything = float(sum(p[1] for p in parts))
    penalty = np.array([[strengths[s]] * (width - 1) + [0.0] for s, _ in models])
    tried, size, step = beta.copy(), np.ones(count), np.zeros((count, width))
    best, right, claims = np.full(count, np.inf), np.zeros(count), np.zeros(count)
    done = np.zeros(count, dtype=bool)
    for _ in range(iterations + 1):
        gradients, losses, hits, held, curves = evaluate(np.array([c.T @ b for c, b in zip(to_fold, tried)]))
        for m, (s, _) in enumerate(models):
            if done[m]:
                continue
            loss = losses[m] / rows_of[m] + (penalty[m] * tried[m] ** 2).sum() / 2
            if loss > best[m] + 1e-12 * (1 + abs(best[m])) and size[m] > 1e-6:
                size[m] /= 2
            else:
                beta[m], best[m], right[m], claims[m], size[m] = tried[m], loss, hits[m], held[m], 1.0
                slope = to_fold[m] @ gradients[m] / rows_of[m] + penalty[m] * beta[m]
                done[m] = fixed[m] or np.abs(slope).max() <= TOLERANCE
                curve = to_fold[m] @ curves[s] @ to_fold[m].T / everything + np.diag(penalty[m])
                step[m] = -np.linalg.solve(curve + np.eye(width) * 1e-10, slope)
            tried[m] = beta[m] if done[m] else beta[m] + size[m] * step[m]
        if done.all():
            break
    return [
        (strengths[s], held, int(claims[m]), float(right[m] / claims[m]) if claims[m] else None)
        for m, (s, held) in enumerate(models)
    ]
