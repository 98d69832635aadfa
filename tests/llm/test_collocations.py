"""Stripes and phrase collocations against counting every sequence."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from claimwright.llm import collocations, stripes

SCHEMA = "doc_id long, text string, lang string, hash int, f string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i : i + s]) for s in range(1, longest + 1) for i in range(len(words) - s + 1))
    frequent = {g: a for g, a in counts.items() if a >= least and len(g) > 2}
    inside = {}
    for g, a in frequent.items():
        for t in range(2, len(g) - 1):
            for j in range(1, len(g) - t + 1):
                part = (g[0], *g[j : j + t])
                inside[part] = max(inside.get(part, 0), a)
    found = {}
    for g, a in frequent.items():
        if 100 * inside.get(g, 0) < 80 * a:
            cuts = [(counts[g[: k + 1]], counts[(g[0], *g[k + 1 :])]) for k in range(1, len(g) - 1)]
            score, _, (l, r) = min((2000000 * a // (l + r), k, (l, r)) for k, (l, r) in enumerate(cuts))
            found.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -score)
        for lang, phrases in found.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(phrases)[:top], 1)
    )


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new york", "é", "a-b", "日本", "z z", "x" * 50, "end.", "q,r", "go\ton", "l1\nl2", "\x0b", "\x0c"]
    rows = [
        (i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 60))), rng.choice(["en", "en", "fr", None, "und"]))
        for i in range(200)
    ]
    rows += [(1, None, "en"), (2, "", None), (3, "only here", "es"), rows[0], rows[0], (None, "the of the of", "en")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "f") for r in rows], SCHEMA)


@pytest.mark.parametrize("least, longest, top, bits", [(3, 4, 2000, 1 << 16), (2, 3, 7, 64), (1, 2, 5, 1 << 16)])
def test_phrases_match_plain_version(spark, least, longest, top, bits):
    rows = corpus()
    got = collocations.collocations(frame(spark, rows).repartition(3), least, longest, top, sieve_bits=bits).collect()
    assert sorted(map(tuple, got)) == plain(rows, least, longest, top)


def test_empty_tables_and_a_very_long_text(spark):
    assert collocations.collocations(frame(spark, []).limit(0)).count() == 0
    rows = [(1, None, "en"), (2, " ,;", None)]
    assert collocations.collocations(frame(spark, rows)).count() == 0
    rows = [(1, "big data " * 400_000 + "w" * 2_000_000, "en"), (2, "big data", "en")]
    got = collocations.collocations(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == plain(rows, 30, 4, 2000) and got[0].a == 399_999


def test_exact_beyond_64_bits(spark):
    big = 4 * 10**17
    rows = spark.createDataFrame([(1, [1, 2], big)], "lang_hash long, gram array<long>, a long")
    parts = spark.createDataFrame([(1, [1], big), (1, [2], big + 1)], "lang_hash long, gram array<long>, f long")
    assert collocations._scored(rows, parts).collect()[0].score == 2000000 * big // (2 * big + 1)


def test_merging_counts_rows_that_share_a_hash_apart(monkeypatch):
    monkeypatch.setattr(stripes, "gram_hash", lambda columns: columns[0] * np.uint64(0))
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    found, counts = stripes.added(columns, None)
    expected = Counter(zip(*(c.tolist() for c in columns)))
    assert dict(zip(zip(*(c.tolist() for c in found)), counts.tolist())) == expected


def test_blocks_hold_every_count_once():
    rng = np.random.default_rng(3)
    columns, counts = stripes.added([rng.integers(0, 9, 4000).astype(np.uint64) for _ in range(4)], None)
    held = stripes.Stripes(4, 500)
    buckets = set()
    for bucket, prefixes, ends, following, own in stripes.blocks(columns, counts, 8):
        buckets.add(bucket)
        held.add(stripes.unpacked(prefixes, ends, following), own)
    back, sums = held.take()
    assert len(buckets) == 8 and sums.sum() == 4000
    assert set(zip(*(c.tolist() for c in back), sums.tolist())) == set(zip(*(c.tolist() for c in columns), counts.tolist()))
    assert held.take()[1].size == 0 and stripes.blocks(*held.take(), 8) == []


def test_sieve_forgets_nothing():
    hashes = np.random.default_rng(2).integers(0, 2**63, 3000).astype(np.uint64)
    sieve = stripes.Sieve(1 << 12, *stripes.Sieve.entries(hashes, 1 << 12))
    assert sieve.has(hashes).all() and not stripes.Sieve(1 << 12, *stripes.Sieve.entries(hashes[:3], 1 << 12)).has(hashes[9:]).all()


def test_a_task_holds_one_bucket_at_a_time():
    read = []

    def batches():
        for bucket in (0, 0, 1, 2):
            read.append(bucket)
            words = np.arange(3, dtype=np.uint64) + np.uint64(10 * bucket)
            yield collocations._packed(
                [(bucket, np.array([7, 7], dtype=np.uint64), np.array([3]), words, np.array([1, 2, 1]))]
            )

    merged = collocations._merged(batches(), 2, 2)
    first = next(merged)
    assert read == [0, 0, 1]
    assert first.column("next").to_pylist() == [[0, 1, 2]] and first.column("counts").to_pylist() == [[2, 4, 2]]
    assert [m.column("next").to_pylist() for m in merged] == [[[11]], [[21]]]
