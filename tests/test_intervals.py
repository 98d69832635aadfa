"""Range joins and overlap counts against pairs, exact splits against sorting."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimwright.operators import features
from claimwright.operators.intervals import overlap_counts, range_join

START = datetime(2023, 12, 20)
RANGES = "k string, a timestamp, b timestamp, n int"

ORIGIN = datetime(2020, 1, 1)


def ranges(seed, count):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        a = START + timedelta(days=rng.randint(0, 90))
        rows.append((rng.choice(["hot", "hot", "x", None]), a, a + timedelta(days=rng.choice([-1, 0, 1, 5, 40])), n))
    return [*rows, ("hot", None, START, -1), ("x", START, None, -2)]


def overlap(one, two):
    return one[0] == two[0] and all([*one[1:3], *two[1:3]]) and one[1] < one[2] and two[1] < two[2] and one[1] < two[2] and two[1] < one[2]


def test_overlap_counts_equal_the_number_of_pairs(spark):
    left, right = ranges(1, 200), ranges(2, 150)
    frames = spark.createDataFrame(left, RANGES).repartition(3), spark.createDataFrame(right, RANGES)
    got = overlap_counts(*frames, ["k"], "a", "b").collect()
    assert {r.n: r.overlaps for r in got} == {row[3]: sum(overlap(row, r) for r in right) for row in left}
    assert len(got) == len(left) and overlap_counts(frames[0].limit(0), frames[1], ["k"], "a", "b").count() == 0
    with pytest.raises(ValueError):
        overlap_counts(frames[0].withColumn("overlaps", F.lit(1)), frames[1], ["k"], "a", "b")


@pytest.mark.parametrize("bucket", [3600, 86_400 * 7])
def test_range_join_equals_all_pairs(spark, bucket):
    right = ranges(4, 120)
    points = [(k, a, n) for k, a, _, n in ranges(3, 150)]
    got = range_join(
        spark.createDataFrame(points, "k string, t timestamp, p int"), spark.createDataFrame(right, RANGES), ["k"], "t", "a", "b", bucket
    )
    expected = sorted(
        (p, r[3]) for k, t, p in points for r in right
        if k == r[0] and t and r[1] and r[2] and r[1] <= t < r[2]
    )
    assert got.columns == ["k", "t", "p", "a", "b", "n"]
    assert sorted((r.p, r.n) for r in got.collect()) == expected and expected


@pytest.mark.parametrize("bins, most", [(4, 3), (4096, 10_000)])
def test_exact_split_takes_the_first_rows_of_each_label(spark, bins, most):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a"] * 8 + ["b", None]), rng.choice([1, 2, 2**62, -5, rng.randint(-9, 10**12)])) for i in range(700)]
    rows += [(900 + i, "one", 3) for i in range(1)] + [(950 + i, "same", 7) for i in range(31)]
    frame = spark.createDataFrame(rows, "k long, y string, draw long").repartition(4)
    got = features.exact_split(frame, ["k"], "y", order=F.col("draw"), bins=bins, most=most).collect()
    assert len(got) == len(rows)
    for y in {r[1] for r in rows}:
        own = sorted((r[2], r[0]) for r in rows if r[1] == y)
        train = len(own) - math.ceil(len(own) * 0.2)
        assert sorted((r.draw, r.k) for r in got if r.y == y and r.is_train) == own[:train]


def test_exact_split_without_a_label_and_of_nothing(spark):
    frame = spark.range(1003).withColumnRenamed("id", "k")
    flagged = features.exact_split(frame, ["k"], most=50)
    assert flagged.filter("is_train").count() == 1003 - 201 and flagged.count() == 1003
    assert features.exact_split(frame.limit(0), ["k"]).count() == 0


def test_overlaps_among_themselves_read_the_ranges_once(spark):
    rows = [(k, i, i + 1 + i % 45) for k in ("x", "y", None) for i in range(0, 120, 7)] * 2
    frame = spark.createDataFrame(rows, "k string, i int, j int").selectExpr(
        "k", "timestamp'2020-01-01' + make_interval(0,0,0,i) AS a", "timestamp'2020-01-01' + make_interval(0,0,0,j) AS b"
    )
    counted = overlap_counts(frame, frame, ["k"], "a", "b")
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    for row in counted.collect():
        assert row.overlaps == sum(
            1 for k, i, j in rows if k == row.k and i < (row.b - ORIGIN).days and j > (row.a - ORIGIN).days
        )
