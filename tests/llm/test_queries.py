"""Registered queries of the subpackage against their SQL, or against plain versions."""

import hashlib

import pytest

from claimwright.llm import registry
from tests.compare import differences, duck
from tests.llm import plain

RUNS, SQL = registry.queries(), registry.oracle_sql()


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in RUNS) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert differences(RUNS[name](spark, sf_dir), duck(sf_dir), SQL[name]) is None


def test_near_duplicates_match_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = plain.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    got = RUNS["op6_simhash_near_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert len({c for *_, c in expected}) < len(expected)


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = RUNS["op3_document_languages"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and 20 <= len(held) <= 60
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = RUNS["op8_document_toxicity"](spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic = [r.score for r in held if r.toxic]
    clean = [r.score for r in held if not r.toxic]
    ranked = sum(t > c for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert ranked >= 0.9
    assert sum(r.predicted and not r.toxic for r in held) <= 0.03 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_empty_hash_is_of_the_empty_list(spark, sf_dir):
    rows = RUNS["op5_contaminated_documents"](spark, sf_dir).filter("n_items = 0").collect()
    assert {r.items_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
