"""The pipeline against its stages in plain Python."""

import re

import pytest

import corpus_pipeline
from claimwright.llm import secrets
from tests.llm import plain
from tests.llm.test_secrets import plain as plain_secrets


def masked(texts):
    found = []
    for text, (_, spans) in zip(texts, plain_secrets(texts)):
        out, at = "", 0
        for start, _, end in spans:
            if end > at:
                if start >= at:
                    out += text[at:start] + secrets.MASK
                at = end
        found.append(out + text[at:] if spans else text)
    return found


def plain_run(docs, items):
    """``(doc_id, text, reading, position)`` of the mix."""
    rows = []
    for doc_id, text, source in docs:
        _, _, kept, clean = plain.quality(text)
        if kept:
            rows.append((doc_id, clean, source))
    keep = {c for *_, c in plain.near_duplicates([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] in keep]
    counted = [plain.contamination(text, items) for _, text, _ in rows]
    rows = [r for r, (n, hit, _) in zip(rows, counted) if not (hit and 20 * hit >= n)]
    rows = [(i, t, s) for (i, _, s), t in zip(rows, masked([r[1] for r in rows]))]
    readings, _ = plain.readings(rows)
    return [(rows[n][0], rows[n][1], reading, position) for n, reading, position in readings]


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir).collect()


def test_matches_plain_version(spark, sf_dir, result):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = plain_run(docs, items)
    assert [r.position for r in result] == sorted(r.position for r in result)
    key = lambda r: (r[0], r[1], r[2], round(r[3], 9))
    got = sorted(key((r.doc_id, r.text, r.reading, r.position)) for r in result)
    assert got == sorted(map(key, expected))
    assert 50 < len({r.doc_id for r in result}) < len(docs)


def test_no_secret_is_left(result):
    for r in result:
        assert not re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text)
        assert r.n_chars == len(r.text)


def test_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "mixing",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_null_columns_and_no_documents(spark, sf_dir):
    rows = [
        (None, None, None, None, None), (1, None, None, None, None), (None, "ten words " * 10 + ".", None, None, 5),
        (2, "one two three four five six seven eight nine ten eleven.", None, "s", None),
        (2, "one two three four five six seven eight nine ten eleven.", None, "s", None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for start in (docs, docs.limit(0)):
        at = start
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, sf_dir)
        assert sorted({r.doc_id for r in at.collect()}) == ([2] if start is docs else [])
