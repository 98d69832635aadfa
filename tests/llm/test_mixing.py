"""Targets, readings and positions against sharing and inverting step by step."""

import random

import pytest

from claimwright.llm import mixing, q_mixing
from tests.llm import plain


def corpus():
    rng = random.Random(9)
    rows = []
    for source, count, most in ((None, 5, 40), ("a", 300, 60), ("b", 3, 10), ("c", 40, 200), ("é", 2, 5), ("z", 1, 1)):
        rows += [(len(rows) + k, "w " * rng.randint(0, most), source) for k in range(count)]
    rows += [(900, None, "a"), (901, "", "b"), (None, "x y z", "c"), (None, "x y z", "c"), rows[10], rows[10]]
    return rows


def test_readings_match_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, source string, size int, target int")
    expected, share = plain.readings(rows)
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(rows)
    for r in planned:
        assert r.target == pytest.approx(share[r.row.source])
        assert r.taken == len(r.positions) * r["size"] <= 3 * r["size"]
    got = mixing.readings(docs).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    key = lambda r: (str(r[0]), r[1], round(r[2], 9))
    assert sorted(key((r.doc_id, r.reading, r.position)) for r in got) == sorted(
        key((rows[n][0], reading, position)) for n, reading, position in expected
    )
    taken = {}
    for r in planned:
        taken[r.row.source] = taken.get(r.row.source, 0) + r.taken
    longest = {s: max(len((t or "").split()) for _, t, x in rows if x == s) for s in share}
    assert all(abs(taken[s] - share[s]) <= longest[s] for s in share)
    assert sum(share.values()) == pytest.approx(sum(len((t or "").split()) for _, t, _ in rows))


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    once = mixing.curriculum(docs.repartition(1)).collect()
    again = mixing.curriculum(docs.repartition(7)).collect()
    assert once == again or sorted(map(str, once)) == sorted(map(str, again))


def test_query_sorts_by_position(spark, sf_dir):
    """The registered query computes positions and range-sorts by them; schedules change its result."""
    query = q_mixing.mixed_documents(spark, sf_dir)
    text = query._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in text.upper() and "Sort [first_position" in text
    rows = query.collect()
    first = [r.first_position for r in rows if r.taken]
    assert first == sorted(first) and all(r.first_position is None for r in rows if not r.taken)
    assert all(0 < r.first_position <= r.last_position < 1 for r in rows if r.taken)
    flat = mixing.plan(spark.read.parquet(f"{sf_dir}/documents.parquet"), schedules=((1.0, 1.0),)).collect()
    assert sorted(p.positions[0] for p in flat if p.taken) != sorted(first)


def test_schedules_move_the_sources(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(docs, weights=(1, 1), schedules=((2.0, 0.0), (0.0, 2.0))).collect()
    early = [p for r in got if r.row.source == "a" for p in r.positions]
    late = [p for r in got if r.row.source == "b" for p in r.positions]
    assert sum(early) / len(early) == pytest.approx(1 / 3, abs=0.01)
    assert sum(late) / len(late) == pytest.approx(2 / 3, abs=0.01)


def test_empty_tables_and_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.plan(docs).collect()] == [0, 0]
    assert mixing.readings(docs).count() == 0 and mixing.plan(docs.limit(0)).count() == 0
