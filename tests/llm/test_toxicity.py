"""Restoration of disguised words, and scores on planted ones."""

import math
import random

import numpy as np
import pytest

from claimwright.llm import deobfuscate, toxicity

VOCABULARY = "the people think about nothing while reading several letters from their friends today".split()
BAD = ["idiot", "moron", "pathetic"]


def corpus(count, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = [rng.choice(VOCABULARY) for _ in range(rng.randint(5, 40))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(400)[0], "doc_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    extra = [(0, None), (None, 1), (10_000, 1)]
    return spark.createDataFrame(corpus(400)[1] + extra, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def chars(docs):
    return deobfuscate.char_model(docs)


@pytest.fixture(scope="module")
def model(docs, labels):
    return toxicity.fit(docs, labels)


@pytest.mark.parametrize(
    "disguised, meant",
    [
        ("1d10t", "idiot"), ("m0r0n", "moron"), ("p@th3tic", "pathetic"), ("i d i o t", "idiot"),
        ("m.o.r.o.n", "moron"), ("idiooooot", "idiot"), ("MOOORON", "moron"), ("the people", "the people"),
        ("in 2024 at 10:30", "in 2024 at 10:30"), ("", ""), ("letters!! reading$$$", "letters!! reading$$$"),
    ],
)
def test_restoration(chars, disguised, meant):
    assert deobfuscate.restorer(chars)(disguised) == meant


@pytest.mark.parametrize(
    "disguised, meant",
    [
        ("what an 1d107", "what an idiot"), ("idi07", "idiot"), ("m0r0n5", "morons"), ("letter5", "letters"),
        ("friend5 today", "friends today"), ("iddiiott", "idiot"), ("mmoorroonn", "moron"), ("iddiot", "idiot"),
        ('"i d i o t"', '"idiot"'), ("(m o r o n)", "(moron)"), ("[p.a.t.h.e.t.i.c]", "[pathetic]"),
        ("“m-o-r-o-n”", "“moron”"), ("t h e people", "the people"), ("'t h e'", "'the'"),
        ("several letters", "several letters"), ("1 2 3 and 4", "1 2 3 and 4"), ("(a) 10, 20", "(a) 10, 20"),
    ],
)
def test_restoration_of_more_forms(chars, disguised, meant):
    """Look-alikes at the end, doubled letters, and spaced words in brackets or of three letters."""
    assert deobfuscate.restorer(chars)(disguised) == meant


def test_decoding_finds_the_cheapest_path(chars):
    def paths(steps):
        if not steps:
            yield "", 0.0
            return
        for rest, cost in paths(steps[:-1]):
            for piece, charge in steps[-1]:
                yield rest + piece, cost + charge

    def total(text, charge):
        a = b = 0x20
        for byte in (text + " ").encode():
            c = int(deobfuscate._INSIDE[byte])
            charge += chars.cost(a, b, c)
            a, b = b, c
        return charge

    for word in ("1d10t", "p4+h3t1c", "l3tt3rs", "n0oooth1ng"):
        steps = deobfuscate._lattice(word, False)
        costs = {}
        for text, charge in paths(steps):
            costs[text] = min(total(text, charge), costs.get(text, math.inf))
        assert deobfuscate.decode(word, chars) == min(costs, key=costs.get)


def test_grams_of_all_documents_are_counted(docs, chars):
    text = " \n".join(t for _, t in corpus(400)[0])
    assert chars.pairs[ord("t") << 8 | ord("h")] == text.count("th")
    bucket = deobfuscate._gram_bucket(*b"the")
    assert chars.triples[bucket] >= text.count("the")


def test_scores(spark, model):
    rows, marks = corpus(200, seed=8)
    disguise = str.maketrans("ioe", "103")
    for i, (doc_id, text) in enumerate(rows):
        rows[i] = (doc_id, " ".join(w.translate(disguise) if w in BAD else w for w in text.split()))
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum(got[i].predicted == t for i, t in marks) >= 0.97 * len(marks)


def test_edge_rows(spark, model):
    rows = [(1, None, 0), (2, "", 0), (None, "idiot moron pathetic", 1), (3, "idiot " * 100_000, 1), (3, "the", 0)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score int"), model).collect()
    by_id = {(r.doc_id, r.predicted): r.score for r in got}
    assert by_id[1, 0] == by_id[2, 0] < 0.5 and (None, 1) in by_id and (3, 1) in by_id and len(got) == 5
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(empty, model).count() == 0
    assert [r.text for r in toxicity.restored(spark.createDataFrame(rows, "doc_id long, text string, x int"), model.chars).collect()][:3] == [None, "", "idiot moron pathetic"]


def test_one_label_or_none(spark, docs):
    clean = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, clean)).collect()} == {0}
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, clean.limit(0))).collect()} == {0}
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, clean)).count() == 0
    assert np.isfinite(toxicity.fit(empty, clean).intercept)
