"""Noisy-channel restoration of disguised words: Viterbi decoding under a character model.

The character model has byte trigrams of lower-cased words from all documents, counted in
``BUCKETS`` hash buckets, so its size is bounded while its counts grow with the corpus.

A disguised word is a lattice. A letter stands for itself; a digit or sign that resembles letters
stands for each of them or for itself; a run of one letter stands for one or two of it; single
characters set apart by blanks, dots, dashes, stars or underscores stand for one word or several. The
channel charges for every change, the model for every byte, and the cheapest path is the restored word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.text import LOWER, joined, slices

BUCKETS = 1 << 18
_PAIRS = 1 << 16

# Letters that a digit or sign resembles.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
CHANGE, LITERAL, SHORTEN, DOUBLE, BREAK = 0.7, 2.0, 0.5, 0.5, 4.0

_INSIDE = np.full(256, 0x20, dtype=np.uint8)
_INSIDE[0x61:0x7B] = np.arange(0x61, 0x7B)
_INSIDE[0x80:] = np.arange(0x80, 0x100)

_UNIT = r"[^\W\d_]|[0-9@$!|+]"
_OPENING, _CLOSING = r"\s\"'(\[{<«»‹›“”„‘’—–", r"\s.,;:!?\"')\]}>«»‹›“”‘’—–…"
_LETTER, _SIGN, _BLANKS = r"[^\W\d_]", r"[0-9@$!|+(€£]", r"[ ._*\-]{1,3}"
# Three units need a letter among them, as three numbers in a row are no word.
_SPACED = (
    rf"(?<![^{_OPENING}])(?:(?:{_UNIT})(?:{_BLANKS}(?:{_UNIT})){{3,}}"
    rf"|(?=(?:[0-9@$!|+]{_BLANKS}){{0,2}}{_LETTER})(?:{_UNIT})(?:{_BLANKS}(?:{_UNIT})){{2}})(?![^{_CLOSING}])"
)
_LEETED = (
    rf"(?<!{_LETTER}){_LETTER}++(?:{_SIGN}++{_LETTER}[\w@$!|+(€£]*"
    rf"|(?<={_LETTER}{_LETTER})[@$]{{1,2}}(?![^\s.,;:!?])|{_SIGN}*[0-9][@$+]{{0,2}}(?!\w))"
    rf"|(?!\({_SPACED}){_SIGN}++{_LETTER}[\w@$!|+(€£]*"
)
_REPEATED = rf"(?<!\w)\w*?(?P<run>{_LETTER})(?P=run)\w*"
_DISGUISED = re.compile(f"(?P<spaced>{_SPACED})|{_LEETED}|{_REPEATED}")
# Cheap necessary condition for the above.
_HINT = re.compile(
    r"[0-9@$!|+(€£]\w|\w[0-9@$]|([^\W\d_])\1"
    r"|(?<!\w)[\w@$!|+][ ._*\-]{1,3}[\w@$!|+][ ._*\-]{1,3}[\w@$!|+](?![^\W_])"
)


def _gram_bucket(a, b, c):
    return ((a * 0x10000 + b * 0x100 + c) * 2654435761 & 0xFFFFFFFF) >> 14


class CharModel:
    """Interpolated byte trigram costs (negative logarithms)."""

    def __init__(self, triples: np.ndarray, pairs: np.ndarray):
        self.triples, self.pairs = triples, pairs
        self.singles = pairs.reshape(256, 256).sum(axis=0) + 1.0
        self.total = float(self.singles.sum())

    @lru_cache(maxsize=1 << 18)  # noqa: B019  one model per worker
    def cost(self, a: int, b: int, c: int) -> float:
        one = self.singles[c] / self.total
        two = (self.pairs[b << 8 | c] + 8 * one) / (self.pairs[b << 8 : (b + 1) << 8].sum() + 8)
        three = (self.triples[_gram_bucket(a, b, c)] + 8 * two) / (self.pairs[a << 8 | b] + 8)
        return -math.log(min(1.0, three))

    def __reduce__(self):
        return CharModel, (self.triples, self.pairs)


def count_grams(docs: DataFrame) -> DataFrame:
    """``kind, bucket, n``: byte trigrams (kind 3) and bigrams (kind 2) of the words of all texts."""
    rows = docs.select(F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, pairs = np.zeros(BUCKETS, dtype=np.int64), np.zeros(_PAIRS, dtype=np.int64)
        for part in slices(batches):
            data, _ = joined(part.column("text"))
            codes = _INSIDE[LOWER[data]].astype(np.uint32)
            if len(codes) < 3:
                continue
            a, b, c = codes[:-2], codes[1:-1], codes[2:]
            held = (b != 0x20) | (c != 0x20)
            gram = (a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(2654435761)
            triples += np.bincount(gram[held] >> np.uint32(14), minlength=BUCKETS)
            pairs += np.bincount((b << np.uint32(8) | c)[held], minlength=_PAIRS)
        for kind, counts in ((3, triples), (2, pairs)):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), kind, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                ["kind", "bucket", "n"],
            )

    counted = rows.mapInArrow(run, "kind int, bucket int, n long")
    return counted.groupBy("kind", "bucket").agg(F.sum("n").alias("n"))


def char_model(docs: DataFrame) -> CharModel:
    """The character model of all documents; at most ``BUCKETS`` + 65,536 rows come to the driver."""
    table = count_grams(docs).toPandas()
    arrays = []
    for kind, size in ((3, BUCKETS), (2, _PAIRS)):
        counts = np.zeros(size)
        own = table[table["kind"] == kind]
        counts[own["bucket"].to_numpy()] = own["n"].to_numpy()
        arrays.append(counts)
    return CharModel(*arrays)


def _lattice(word: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """Alternatives with their channel costs, position by position."""
    units = re.findall(r"[ ._*\-]+|.", word) if spaced else list(word)
    steps: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(units):
        unit = units[at]
        if spaced and re.fullmatch(r"[ ._*\-]+", unit):
            steps.append([("", 0.0), (" ", BREAK if len(unit) == 1 else 0.2)])
            at += 1
            continue
        run = 1
        while at + run < len(units) and units[at + run] == unit:
            run += 1
        if unit.isalpha():
            if run == 1:
                steps.append([(unit, 0.0)])
            elif run == 2:
                steps.append([(unit * 2, 0.0), (unit, SHORTEN + 1.5)])
            else:
                steps.append([(unit, SHORTEN), (unit * 2, DOUBLE)])
        else:
            for _ in range(run):
                meant = [(c, CHANGE) for c in LOOKALIKES.get(unit, "")]
                steps.append([*meant, (unit, LITERAL)])
        at += run
    return steps


def decode(word: str, model: CharModel, spaced: bool = False) -> str:
    """The cheapest reading of a disguised, lower-cased word."""
    paths: dict[tuple[int, int], tuple[float, str]] = {(0x20, 0x20): (0.0, "")}
    for step in [*_lattice(word, spaced), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in paths.items():
            for piece, charge in step:
                total, x, y = cost + charge, a, b
                for byte in piece.encode():
                    code = int(_INSIDE[byte])
                    total += model.cost(x, y, code)
                    x, y = y, code
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, text + piece)
        paths = after
    return min(paths.values())[1].strip()


def restorer(model: CharModel):
    """A function from a text to its lower-cased, restored text; words are decoded once per task."""

    @lru_cache(maxsize=1 << 16)
    def decoded(word: str, spaced: bool) -> str:
        return decode(word, model, spaced)

    def replace(match: re.Match) -> str:
        return decoded(match[0], match["spaced"] is not None)

    def restore(text: str) -> str:
        text = text.lower()
        return _DISGUISED.sub(replace, text) if _HINT.search(text) else text

    return restore
