"""Shards by a k-d tree against a plain walk through its cuts."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimwright.llm import sharding
from claimwright.llm.q_sharding import sharded_documents


def code(value):
    return -1.0 if value is None else float(int.from_bytes(value.encode()[:6].ljust(6, b"\0"), "big"))


def corpus(seed=3, copies=150):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        text = "".join(rng.choice("abc é") for _ in range(rng.randint(0, 400)))
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "web", "é"]), rng.randint(0, 99)))
    rows += [(1000 + i, "copy " * 40, "en", rng.choice(["s1", "web"]), 7) for i in range(copies)]
    rows += [(2000, None, None, None, None), (2000, None, None, None, None), (None, "x", "en", "s1", 3), (3, "", "en", "s1", 0)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def checked(rows, placed, shards, near):
    """Walks through the tree: every cut is along the widest dimension and near the median."""
    group = {}
    for _, text, lang, source, n in rows:
        at = (code(source), code(lang), -1.0 if n is None else float(n))
        group[text] = tuple(map(min, group.get(text, at), at))
    points = {(r[0], r[1]): (group[r[1]], len((r[1] or "").encode()) + 1) for r in rows}
    cells = [(*points[key], shard) for key, shard in placed]
    extent = [max(c[0][i] for c in cells) - min(c[0][i] for c in cells) for i in range(3)]
    largest = max(c[1] for c in cells)
    target = sum(c[1] for c in cells) / shards

    def walk(own, first, count):
        if count == 1 or not own:
            assert {c[2] for c in own} <= {first}
            return
        half = count // 2
        left = [c for c in own if c[2] < first + half]
        right = [c for c in own if c[2] >= first + half]
        parts = [
            (max(c[0][i] for c in own) - min(c[0][i] for c in own)) / extent[i] if extent[i] else 0 for i in range(3)
        ]
        axis = parts.index(max(parts))
        if left and right:
            assert max(c[0][axis] for c in left) <= min(c[0][axis] for c in right)
        goal = sum(c[1] for c in own) * half / count
        assert abs(sum(c[1] for c in left) - goal) <= largest + near * target
        walk(left, first, half)
        walk(right, first + half, count - half)

    walk(cells, 0, shards)


@pytest.mark.parametrize("shards", [5, 8])
def test_cuts_are_weighted_medians_of_the_widest_dimension(spark, shards):
    rows = corpus()
    placed = sharding.assign(
        spark.createDataFrame(rows, SCHEMA), shards=shards, carry=[F.col("doc_id"), F.col("text")]
    ).collect()
    assert len(placed) == len(rows)
    checked(rows, [((r.doc_id, r.text), r.shard) for r in placed], shards, sharding.TOGETHER)
    for r in placed:
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
    for shard in range(shards):
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots))) and slots
    total, sizes = sum(r["size"] for r in placed), [0] * shards
    for r in placed:
        sizes[r.shard] += r["size"]
    assert max(abs(s - total / shards) for s in sizes) <= 0.05 * total / shards + 401


def test_small_groups_of_equal_texts_stay_together(spark):
    rng = random.Random(1)
    rows = [(i, f"text {i // 3} " * 30, rng.choice(["en", "de"]), rng.choice("abcd"), i) for i in range(6000)]
    placed = sharding.assign(spark.createDataFrame(rows, SCHEMA), shards=4).collect()
    home = {}
    for r in placed:
        home.setdefault(r.doc_id // 3, set()).add(r.shard)
    assert all(len(s) == 1 for s in home.values())
    sizes = [sum(r["size"] for r in placed if r.shard == s) for s in range(4)]
    assert max(sizes) <= 1.03 * min(sizes)


def test_one_text_only_is_cut_into_equal_parts(spark):
    rows = [(i % 700, "same", "en", "a", 4) for i in range(1000)]
    placed = sharding.assign(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=8).collect()
    counts = [sum(r.shard == s for r in placed) for s in range(8)]
    assert sum(counts) == 1000 and max(counts) - min(counts) <= 3


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    once = sharding.assign(docs.repartition(1), shards=3).collect()
    again = sharding.assign(docs.repartition(7, "doc_id"), shards=3).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_empty_tables_few_rows_and_wrong_arguments(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    assert sharding.assign(docs.limit(0), shards=8).count() == 0
    few = sharding.assign(docs.limit(2), shards=8).collect()
    assert len(few) == 2 and all(0 <= r.shard < 8 for r in few)
    for wrong in ({}, {"shards": 0}, {"shards": 2, "target_bytes": 5}, {"shards": 2, "dimensions": ()}):
        with pytest.raises(ValueError):
            sharding.assign(docs, **wrong)
    with pytest.raises(ValueError):
        sharding.assign(docs.withColumn("tags", F.array("lang")), shards=2, dimensions=["tags"])


def test_clashing_columns_dates_and_very_long_texts(spark):
    rows = [(i, "x" * (3_000_000 if i == 5 else 100_000), "2024-01-%02d" % (1 + i % 28), 9, 9.5) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, day string, shard int, node double").withColumn(
        "day", F.to_date("day")
    )
    placed = sharding.assign(docs, shards=2, dimensions=["day", "node"]).collect()
    sizes = [sum(r["size"] for r in placed if r.shard == s) for s in (0, 1)]
    assert len(placed) == 64 and abs(sizes[0] - sizes[1]) <= 3_000_002


def test_written_shards_hold_every_document(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    sizes = sharding.write_shards(docs, str(tmp_path / "out"), target_bytes=20_000, file_rows=50).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard", "slot").exceptAll(docs).isEmpty() and back.count() == docs.count()
    assert {r.shard: r.documents for r in sizes} == {r.shard: r["count"] for r in back.groupBy("shard").count().collect()}
    assert max(r.bytes for r in sizes) <= 1.1 * 20_000 + 401


def test_query_has_the_contract_columns(spark, sf_dir):
    frame = sharded_documents(spark, sf_dir)
    assert frame.dtypes == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
        ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int"),
    ]
    rows = frame.collect()
    assert len(rows) == 200 and {r.law for r in rows} == {"bytes"}
    assert sorted((r.shard, r.slot) for r in rows) == [
        (s, k) for s in range(8) for k in range(sum(r.shard == s for r in rows))
    ]
