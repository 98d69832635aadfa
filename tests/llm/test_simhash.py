"""Fingerprints, links and components against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from claimwright.llm import simhash
from claimwright.llm.graph import components
from claimwright.session import settle
from tests.llm import plain


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def pairs(values, bits):
    return {
        tuple(sorted((signed(a), signed(b))))
        for i, a in enumerate(values)
        for b in values[:i]
        if (a ^ b).bit_count() <= bits
    }


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [1, 3, 64])
def test_links_match_all_pairs(spark, bits, bucket):
    rng = random.Random(bits * 10 + bucket)
    values = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    for value in values[:30]:  # near ones, and many that share half of their bits
        for size in (1, 2, 3, 4):
            values.append(value ^ sum(1 << b for b in rng.sample(range(64), size)))
    values += [values[0] & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(20)]
    values = sorted(set(values))
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    if bits == 3 and bucket < 64:
        values = values[:12]  # whole balls of three bits have 43,744 members
        frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    got = {(r.a, r.b) for r in simhash.links(frame, bits, bucket).collect()}
    assert got == pairs(values, bits)


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 4)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(5)
    names = rng.sample(range(-1000, 1000), 300)
    links = list(zip(names[:100], names[1:100])) + [(names[100], n) for n in names[101:200]]
    links += [(b, a) for a, b in links[:5]] + [(names[250], names[250])]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for part in (names[:100], names[100:200]):
        assert {got[n] for n in part} == {min(part)}
    assert len(got) == 200


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    for i in range(80, 140):
        text = rows[rng.randrange(80)][1].split()
        if text and i % 3:
            text[rng.randrange(len(text))] = "Changed"
        rows.append((i, "\t".join(text).upper() if i % 2 else " ".join(text)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "one"), (204, "One"), (205, "one two"), (None, "one")]
    rows += [(206, "é ü x"), (207, "long " * 30_000), rows[3], rows[3]]
    return rows


def test_components_match_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame(
        [(a, b, 0, "c") for a, b in rows], "doc_id long, text string, fingerprint int, component_id string"
    )
    got = sorted(map(str, map(tuple, simhash.near_duplicates(docs).collect())))
    assert got == sorted(map(str, plain.near_duplicates(rows)))
    small = simhash.near_duplicates(docs, bucket=1)
    assert sorted(map(str, map(tuple, small.collect()))) == got


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(a, b, "s", 1) for a, b in rows], "doc_id long, text string, root string, n int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {c for *_, c in plain.near_duplicates(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}
    assert sorted(str(r.text) for r in simhash.keep_one(docs).collect()) == ["None", "a b c"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def joins(frame):
    """Kind, first key and type of each join of the plan."""
    return re.findall(r"(\w+Join) \[(\w+)#.*?, (\w+)(?:, |$)", plan_of(frame), re.M)


def plan_of(frame):
    return re.sub(r"Join \[([^]]*)\], \[[^]]*\]", r"Join [\1]", frame._jdf.queryExecution().executedPlan().toString())


def test_lookups_are_not_broadcast(spark):
    """A small table of fingerprints has many times as many lookups, which Spark takes for as small."""
    rng = random.Random(9)
    prints = settle(spark.createDataFrame([(signed(rng.getrandbits(64)),) for _ in range(300)], "fingerprint long"))
    crowded = settle(prints.select(F.expr("fingerprint & -4294967296 | 5").alias("fingerprint")))
    for frame, kinds in ((prints, {"Inner"}), (crowded, {"Inner", "LeftSemi"})):
        # The full buckets are few and may be broadcast.
        found = [(kind, key, how) for kind, key, how in joins(simhash.links(frame)) if (key, how) != ("segment", "LeftSemi")]
        assert {how for _, _, how in found if how != "LeftAnti"} == kinds
        assert {kind for kind, _, how in found if how != "LeftAnti"} == {"SortMergeJoin"}
    docs = settle(spark.createDataFrame(corpus()[:80], "doc_id long, text string"))
    for frame in (simhash.near_duplicates(docs), simhash.keep_one(docs)):
        assert {*re.findall(r"\w+Join", plan_of(frame))} == {"SortMergeJoin"}


def test_spark_hash_is_the_same(spark):
    row = spark.createDataFrame([("häst und hund",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] == signed(simhash.shingle_hashes("häst und hund".encode(), 3)[0])
