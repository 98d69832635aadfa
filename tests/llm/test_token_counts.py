"""Edited token counts against encoding the edited texts whole."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimwright.llm import token_counts as C
from claimwright.llm.q_token_counts import MARK, PATTERN, PERSONAL, VOCABULARY, document_tokens


@pytest.fixture(scope="module")
def vocabulary():
    return C.Vocabulary.read(VOCABULARY, PATTERN)


_CHARS = "ab Zé9 \n\t'sl.!-ß  x"


def _edit(text, start, end, new):
    start = min(max(start, 0), len(text))
    return text[:start] + new + text[min(max(end, start), len(text)) :]


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_any_edits(data):
    vocabulary = test_any_edits.vocabulary
    text = data.draw(st.text(alphabet=_CHARS, max_size=120))
    tree = C.CountTree(text, vocabulary)
    for _ in range(data.draw(st.integers(1, 5))):
        start = data.draw(st.integers(0, len(text) + 2))
        end = start + data.draw(st.integers(0, 30))
        new = data.draw(st.text(alphabet=_CHARS, max_size=12))
        text = _edit(text, start, end, new)
        tree.replace(start, end, new)
        assert tree.text == text and tree.total == vocabulary.whole(text)


test_any_edits.vocabulary = C.Vocabulary.read(VOCABULARY, PATTERN)


def test_long_text_encodes_little(vocabulary):
    rng = random.Random(1)
    words = ["alpha", "beta,", "gamma\n", "don't", "12345", "déjà", "   "]
    text = " ".join(rng.choice(words) for _ in range(20_000))
    tree = C.CountTree(text, vocabulary)
    for _ in range(200):
        start = rng.randrange(len(text))
        end = start + rng.choice([0, 1, 5, 40, 3000])
        new = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 400])))
        before = tree.encoded
        text = _edit(text, start, end, new)
        tree.replace(start, end, new)
        assert tree.encoded - before <= 2 * len(new) + 12
    assert tree.text == text and tree.total == vocabulary.whole(text)
    half = len(text) // 2
    assert 0 < tree.tokens_before(half) < tree.total
    assert tree.tokens_before(len(text)) == tree.total
    assert sum(tree.chars[tree.width :]) == len(text)


def test_query(spark, sf_dir, vocabulary):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    edited = 0
    for r in document_tokens(spark, sf_dir).collect():
        masked = re.sub(PERSONAL, MARK, docs[r.doc_id])
        assert r.n_tokens == vocabulary.whole(docs[r.doc_id])
        assert r.n_tokens_after == vocabulary.whole(masked)
        assert r.n_chars == len(masked)
        assert r.n_edits == len(re.findall(PERSONAL, docs[r.doc_id]))
        edited += r.n_edits > 0
    assert edited


def test_edit_table_and_edge_rows(spark, vocabulary):
    rows = [(1, "one two three", 0), (1, "one two three", 0), (2, None, 0), (3, "", 0), (None, "x y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits int")
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, None), (1, 1, 4, 7, "2 2"), (3, 0, 5, 9, "abc"), (None, 0, 0, 1, "q"), (9, 0, 0, 1, "q")],
        "doc_id long, seq long, start long, stop long, new string",
    )
    got = C.edited_counts(docs, edits, vocabulary).collect()
    assert len(got) == 5
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_tokens_after == vocabulary.whole(" 2 2 three") and by_id[1].n_edits == 2
    assert by_id[2].n_tokens == by_id[2].n_tokens_after == 0
    assert by_id[3].n_tokens == 0 and by_id[3].n_tokens_after == vocabulary.whole("abc")
    assert by_id[None].n_tokens == vocabulary.whole("x y") and by_id[None].n_edits == 0
    assert C.token_counts(docs, vocabulary).count() == 5
    assert C.edited_counts(docs.limit(0), edits, vocabulary).count() == 0
