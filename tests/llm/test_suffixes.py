"""Repeated passages against all windows of fifty words, counted in Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimwright.llm.suffixes import repeated_passages


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, min_words=50):
    """Merged spans of words in windows that occur twice."""
    words = [words_of(t) for t in texts]
    seen = Counter(
        tuple(w[i : i + min_words]) for w in words for i in range(len(w) - min_words + 1)
    )
    found = []
    for w in words:
        spans = []
        for i in range(len(w) - min_words + 1):
            if seen[tuple(w[i : i + min_words])] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + min_words
                else:
                    spans.append([i, i + min_words])
        found.append([tuple(s) for s in spans])
    return found


def check(docs, texts):
    rows = repeated_passages(docs).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
        F.collect_set("partner").alias("partners"),
    )
    got = {r.doc_id: r for r in rows.collect()}
    for i, spans in plain_by_id(texts).items():
        assert [tuple(s) for s in got[i].spans] == spans if spans else i not in got, i
    return got


def plain_components(texts, min_words=50):
    """Sets of spans (id, first, last) that chains of shared windows join."""
    spans, root, owner = plain_by_id(texts), {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, text in texts.items():
        words = words_of(text)
        for first, last in spans[i]:
            find((i, first, last))
            for at in range(first, last - min_words + 1):
                window = tuple(words[at : at + min_words])
                root[find((i, first, last))] = find(owner.setdefault(window, (i, first, last)))
    groups = {}
    for span in root:
        groups.setdefault(find(span), set()).add(span)
    return sorted(map(sorted, groups.values()))


def check_components(docs, texts):
    groups = {}
    for r in repeated_passages(docs).collect():
        groups.setdefault(r.component, set()).add((r.doc_id, r.first, r.last))
    assert sorted(map(sorted, groups.values())) == plain_components(texts)
    return groups


def plain_by_id(texts):
    return dict(zip(texts, plain(list(texts.values()))))


def test_planted_passages(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(n) for n in (49, 50, 51, 60, 120, 400)]
    texts = {}
    for i in range(60):
        body = prose(rng.randint(0, 200))
        for p in rng.sample(passages, 2):
            at = rng.randint(0, len(body))
            # Parts of passages too, so that partners differ to the left and to the right.
            a, b = sorted(rng.sample(range(len(p) + 1), 2)) if rng.random() < 0.5 else (0, len(p))
            body[at:at] = p[a:b]
        texts[i] = "  ".join(w.upper() if rng.random() < 0.2 else w for w in body)
    texts[60] = texts[61] = " ".join(prose(300))
    texts[62] = " ".join(prose(70) * 3)
    texts[63], texts[64], texts[65] = None, "", " ".join(prose(2000))
    texts[66] = "same " * 5000
    rows = [(i, t, "x", 1) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string, core int")
    got = check(docs, texts)
    check_components(docs, texts)
    assert got[60].partners == [61] and got[61].partners == [60]


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(docs, texts)
    check_components(docs, texts)


def _some(name, n):
    return [f"{name}{i}" for i in range(n)]


K = _some("k", 50)
LINKED = {
    "pairs_that_go_on": [K + _some("x", 20), _some("a", 5) + K + _some("x", 20), K + _some("y", 20), _some("b", 9) + K + _some("y", 20)],
    "two_classes_of_copies": [_some("p", 30) + K + _some("q", 9)] * 2 + [_some("r", 30) + K + _some("s", 9)] * 2,
    "chain": [
        _some(f"u{i}-", 7) + _some(f"m{i}-", 55) + _some(f"m{i + 1}-", 55) + _some(f"v{i}-", 7) for i in range(6)
    ],
    # Each pair of parts agrees on one side of a core; only some reach fifty words.
    "hidden_neighbours": [
        _some(f"l{i % 3}-", 20 - i) + _some("c", 30) + _some(f"r{i % 2}-", 12 + i) for i in range(12)
    ]
    + [_some("z", i) + _some("c", 30)[i:] + _some(f"r{i % 2}-", 40) for i in range(6)],
    "apart": [_some("c", 49) + _some(f"e{i}-", 30) for i in range(4)],
}


@pytest.mark.parametrize("case", LINKED)
def test_components(spark, case):
    texts = {i: " ".join(words) for i, words in enumerate(LINKED[case])}
    groups = check_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)
    if case in ("pairs_that_go_on", "two_classes_of_copies", "chain"):
        assert len(groups) == 1


def test_random_mosaics(spark):
    """Parts of 10 to 45 words, each in several places: many agree on one side of a core."""
    rng = random.Random(11)
    parts = [_some(f"t{i}-", rng.randint(10, 45)) for i in range(12)]
    texts = {i: " ".join(w for _ in range(rng.randint(2, 6)) for w in rng.choice(parts)) for i in range(120)}
    check_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_one_id_for_different_texts(spark):
    texts = [_some("a", 60), _some("b", 70), _some("a", 60) + ["end"], _some("b", 70) + ["end"]]
    rows = [(i, " ".join(t)) for i, t in zip((1, 1, 2, None), texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.last) for r in got) == [(0, 70), (1, 60), (1, 70), (2, 60)]
    assert len({r.component for r in got}) == 2 and len({(r.doc_id, r.text_hash) for r in got}) == 4


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"a{i}" for i in range(55))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "x")], "doc_id long, text string")
    rows = repeated_passages(docs).collect()
    assert [(r.doc_id, r.first, r.last, r.partner) for r in rows] == [(1, 0, 55, 1)]
    assert repeated_passages(docs.limit(0)).count() == 0
