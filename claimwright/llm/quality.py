"""Line-first cleaning: rules per line first, then a verdict on what is left of the document.

A line with words fails by the first rule that holds:

* navigation: three or more separators ``| » › •`` and at most four words for each part;
* boilerplate: at most 30 words and one of ``BOILERPLATE``'s phrases;
* punctuation: three or more symbols ``# * $ % & < >`` and more than one for ten words; or two or
  more words that end in repeated ``!`` or ``?``, at least a fifth of the words; or a short line
  without closing punctuation.

A line is short with fewer than three words. Scripts without spaces have few words a line, so a line
without ASCII letters is short only if it also has fewer than ``MIN_LETTERS`` letters and marks of other
scripts. Closing punctuation is ``CLOSING`` and, beyond ASCII, whatever Unicode counts as closing, final
or other punctuation, such as the full stops of Chinese, Devanagari and Arabic.

Failed lines are removed. A document is rejected if it loses more than half of its word characters,
and by two rules on the whole text: fewer than ten words, or more than a fifth of the words in
repeated five-word windows.

Defined cases: null is an empty text; a text without words is rejected; lines without words are
neither counted nor removed. Repeated rows are judged alike. An empty table gives an empty result.
Each text is read whole. All work is one pass without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.text import SPACED, mix64, rolling, runs_of, slices, split_words

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
LOST_PERCENT = 50
MIN_LETTERS = 10
BOILERPLATE = (
    r"cookies?|privacy policy|terms of (?:use|service)|all rights reserved|javascript|subscribe"
    r"|sign (?:in|up)|log ?in|newsletter|click here|read more|share (?:on|this)|lorem ipsum|copyright"
)
CLOSING = ".!?:;,)]}\"'"

_SEPARATOR = re.compile(rb"\||\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2")  # | » › •
_SYMBOL = re.compile(rb"[#*$%&<>]")
_SHOUT = re.compile(rb"[!?]{2,}(?=[\x20\x09-\x0D]|$)")
_PHRASE = re.compile(rb"(?i)\b(?:" + BOILERPLATE.encode() + rb")\b")
_CLOSED = tuple(c.encode() for c in CLOSING)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = regex.compile(r"[\p{L}\p{M}]")
# What a text must contain for a rule to be able to hold on a line of three words or more.
_SUSPECT = re.compile(rb"[|#*$%&<>]|[!?]{2}|\xc2\xbb|\xe2\x80[\xba\xa2]")

RULES = ("navigation", "boilerplate", "punctuation")
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_navigation", "n_boilerplate", "n_punctuation", "lost_chars",
)


def failed_rule(line: bytes) -> str | None:
    """The rule by which a line fails, if any."""
    words = len(line.split())
    if not words:
        return None
    separators = len(_SEPARATOR.findall(line))
    if separators >= 3 and words <= 4 * (separators + 1):
        return "navigation"
    if words <= 30 and _PHRASE.search(line):
        return "boilerplate"
    symbols = len(_SYMBOL.findall(line))
    if symbols >= 3 and 10 * symbols > words:
        return "punctuation"
    shouts = len(_SHOUT.findall(line))
    if shouts >= 2 and 5 * shouts >= words:
        return "punctuation"
    if words < 3 and not _closed(line.rstrip()) and not _unspaced(line):
        return "punctuation"
    return None


def _closed(line: bytes) -> bool:
    """Whether a line without white space at its end has closing punctuation there."""
    if line[-1] < 0x80:
        return line.endswith(_CLOSED)
    last = line[-4:].decode("utf-8", "ignore")[-1:]
    return last != "" and unicodedata.category(last) in ("Po", "Pe", "Pf")


def _unspaced(line: bytes) -> bool:
    """Whether a line of few words holds enough letters of a script other than Latin."""
    if _ASCII_LETTER.search(line):
        return False
    return len(_LETTER.findall(line.decode("utf-8", "replace"))) >= MIN_LETTERS


def _word_chars(line: bytes) -> int:
    return len(b"".join(line.split()).decode("utf-8", "replace"))


def _lines(text: bytes) -> tuple[list[int], bytes | None]:
    """Line measures of one text, and the cleaned text if a line was removed."""
    lines = text.split(b"\n")
    filled = [line for line in lines if line.strip()]
    counts, lost, kept = dict.fromkeys(RULES, 0), 0, None
    suspect = _SUSPECT.search(text) or _PHRASE.search(text)
    if suspect or any(len(line.split(None, 3)) < 3 for line in filled):
        failures = [failed_rule(line) for line in lines]
        if any(failures):
            kept = b"\n".join(line for line, rule in zip(lines, failures) if not rule)
            for line, rule in zip(lines, failures):
                if rule:
                    counts[rule] += 1
                    lost += _word_chars(line)
    return [len(filled) - len(set(filled)), len(filled), *counts.values(), lost], kept


def evaluate(texts: pa.Array) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """Measures of each text, and the texts without their failed lines."""
    raw = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
    words = split_words(texts, SPACED)
    n_words = np.diff(words.first)
    first_bytes = (words.data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(first_bytes & SPACED[words.data])])
    word_chars = np.concatenate([[0], np.cumsum(chars[words.end] - chars[words.start])])

    repeated = np.zeros(len(words.start) + 1, dtype=np.int64)
    grams = rolling(words.hashes(), WINDOW)
    inside = np.flatnonzero(runs_of(words.first, WINDOW)[: len(grams)])
    if len(inside):
        owner = mix64(words.text_of[inside].astype(np.uint64) + np.uint64(1))
        keys = grams[inside] ^ owner
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(inside), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        starts = inside[twice]
        np.add.at(repeated, starts, 1)
        np.add.at(repeated, starts + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(repeated)[:-1] > 0)])

    table, cleaned = [], []
    for text in raw:
        measures, kept = _lines(text)
        table.append(measures)
        cleaned.append(text if kept is None else kept)
    lines = np.array(table, dtype=np.int64).reshape(len(raw), 6)
    found = {
        "n_words": n_words,
        "word_chars": np.diff(word_chars[words.first]),
        "n_symbols": np.array([len(re.findall(rb"[#*$%&|<>]", t)) for t in raw], dtype=np.int64),
        "n_dup_lines": lines[:, 0],
        "n_repeat_words": np.diff(covered[words.first]),
        "n_lines": lines[:, 1],
        "n_navigation": lines[:, 2],
        "n_boilerplate": lines[:, 3],
        "n_punctuation": lines[:, 4],
        "lost_chars": lines[:, 5],
    }
    found["base_failed"] = (found["n_words"] < MIN_WORDS) | (
        100 * found["n_repeat_words"] > REPEAT_PERCENT * found["n_words"]
    )
    found["kept"] = ~found["base_failed"] & (
        100 * found["lost_chars"] <= LOST_PERCENT * found["word_chars"]
    )
    return found, cleaned


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures of each text, ``base_failed`` and ``kept``."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found, _ = evaluate(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *[pa.array(found[m].astype(np.int64)) for m in MEASURES],
                    pa.array(found["base_failed"]),
                    pa.array(found["kept"]),
                ],
                ["doc_id", *MEASURES, "base_failed", "kept"],
            )

    longs = ", ".join(f"{m} long" for m in MEASURES)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {longs}, base_failed boolean, kept boolean")


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without their failed lines; all columns stay."""
    names = docs.columns
    at = names.index("text")
    schema = docs.schema
    narrow = docs.select(
        *[F.col(f"`{n}`").cast("string").alias(n) if n == "text" else F.col(f"`{n}`") for n in names]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found, cleaned = evaluate(part.column(at))
            columns = list(part.columns)
            columns[at] = pa.array(cleaned, type=pa.binary()).cast(pa.string())
            whole = pa.RecordBatch.from_arrays(columns, names)
            yield whole.filter(pa.array(found["kept"]))

    out = narrow.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in narrow.schema]))
    return with_length(out, schema)


def with_length(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring ``n_chars``, if there is one, in line with a changed text."""
    if "n_chars" not in schema.names:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType))
