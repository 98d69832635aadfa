"""The FM-index and contamination against plain search."""

import random

import numpy as np
import pytest

from claimwright.llm import decontaminate
from claimwright.llm.fm_index import FMIndex, Wavelet, suffix_order
from tests.llm import plain


@pytest.mark.parametrize("seed", range(8))
def test_suffix_order_and_search(seed):
    rng = np.random.default_rng(seed)
    alphabet = [1, 2, 3, 9, 40][seed % 5]
    symbols = rng.integers(0 if seed % 2 else 1, alphabet + 1, 400)
    if seed > 4:
        symbols = np.tile(symbols[:50], 8)  # long repeats
    symbols[-1] = 0
    order = suffix_order(symbols)
    ends = [int(np.flatnonzero(symbols[i:] == 0)[0]) + i for i in range(len(symbols))]
    expected = sorted(range(len(symbols)), key=lambda i: (*[int(x) for x in symbols[i : ends[i]]], 0, ends[i])[:500])
    # Segment ends are smaller than any symbol and ordered by place.
    keys = [tuple((int(x), 0) for x in symbols[i : ends[i]]) + ((0, ends[i]),) for i in range(len(symbols))]
    expected = sorted(range(len(symbols)), key=lambda i: keys[i])
    assert order.tolist() == expected

    index = FMIndex(symbols, alphabet, sample=4)
    phrases = np.zeros((200, 6), dtype=np.int64)
    lengths = rng.integers(1, 7, 200)
    for row, length in enumerate(lengths):
        if row % 2:
            at = int(rng.integers(0, len(symbols) - 6))
            phrases[row, :length] = np.maximum(symbols[at : at + length], 1)
        else:
            phrases[row, :length] = rng.integers(1, alphabet + 1, length)
    low, high = index.search(phrases, lengths)
    for row, length in enumerate(lengths):
        sought = phrases[row, :length].tolist()
        places = [i for i in range(len(symbols)) if symbols[i : i + length].tolist() == sought]
        assert sorted(index.locate(np.arange(low[row], high[row])).tolist()) == places


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 13, 1000)
    wavelet = Wavelet(sequence, 12)
    at = rng.integers(0, 1001, 300)
    symbol = rng.integers(0, 13, 300)
    expected = [int((sequence[:a] == s).sum()) for a, s in zip(at, symbol)]
    assert wavelet.rank(symbol, at).tolist() == expected
    got, rank = wavelet.access(np.arange(1000))
    assert got.tolist() == sequence.tolist()
    assert rank.tolist() == [int((sequence[:i] == sequence[i]).sum()) for i in range(1000)]


def corpus():
    rng = random.Random(4)
    words = [f"t{i}" for i in range(60)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate((1, 2, 5, 12, 13, 14, 40, 75, 20, 20))]
    items[0] = (0, "unseenword")
    items += [(10, None), (11, ""), (12, "-- ,,"), (5, items[7][1]), (None, items[8][1]), (2, items[2][1])]
    texts = [None, "", "...", items[6][1], items[4][1].upper().replace(" ", " -- "), "é" + items[5][1]]
    for _ in range(60):
        body = prose(rng.randint(0, 400))
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, len(part))
            at = rng.randint(0, len(body))
            body[at:at] = part[:cut] if rng.random() < 0.5 else part
        texts.append(", ".join(body))
    texts.append(" ".join(prose(3000) + items[7][1].split()))
    return texts + [texts[3]], items


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_matches_plain_version(spark, block_bytes):
    texts, items = corpus()
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, spans string, items int")
    benchmark = spark.createDataFrame([(a, b, "z") for a, b in items], "item_id long, text string, doc_id string")
    found = decontaminate.scan(docs, benchmark, block_bytes=block_bytes).collect()
    assert len(found) == len(texts)
    for r in found:
        n_words, n_hit, listed = plain.contamination(texts[r.row.doc_id], items)
        spans = [(s["first"], s["last"]) for s in r.spans]
        assert (r.n_words, sum(b - a for a, b in spans), set(r.items)) == (n_words, n_hit, listed)
        assert len(r.items) == len(set(r.items))
        for s in r.spans:  # code points of the span hold just its words
            own = plain.ALNUM.findall(plain.lower(r.text))[s["first"] : s["last"]]
            assert plain.ALNUM.findall(plain.lower(r.text[s["start"] : s["end"]])) == own
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_filter_and_cut_keep_columns(spark):
    texts, items = corpus()
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, row string, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.uncontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    expected = [
        i for i, t in enumerate(texts)
        for n, hit, _ in [plain.contamination(t, items)] if not (hit and 20 * hit >= n)
    ]
    assert sorted(r.doc_id for r in kept.collect()) == expected
    cut = decontaminate.without_spans(docs, benchmark)
    assert cut.columns == docs.columns
    for r in cut.collect():
        n, hit, _ = plain.contamination(texts[r.doc_id], items)
        assert len(plain.ALNUM.findall(plain.lower(r.text))) == n - hit or hit
        assert r.text == texts[r.doc_id] or hit


def test_empty_tables(spark):
    texts, items = corpus()
    docs = spark.createDataFrame([(1, texts[3])], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0
    row = decontaminate.contamination(docs, benchmark.limit(0)).first()
    assert (row.n_hit, row.items, row.contaminated) == (0, [], False)
