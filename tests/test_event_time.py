"""Windows, duplicates, running baselines and as-of joins: late rows, restarts, replays, hot keys."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimwright.operators import statistics as stats
from claimwright.operators import sketches
from claimwright.operators.asof import asof_join
from claimwright.streaming import baselines, ingest, windows

START = datetime(2024, 3, 1)
SCHEMA = "id long, user long, at timestamp, bad boolean, value double"


def at(hours):
    return START + timedelta(hours=hours)


def load(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, windowed):
    """Runs the stream over what is new; its rows so far and the last progress."""
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = windowed(ingest.file_stream(spark, str(tmp_path / "in"), schema))
    query = ingest.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    progress = [json.loads(p.json) for p in query.recentProgress]
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out")), progress


def test_windows_wait_for_late_rows_and_drop_what_is_later(spark, tmp_path):
    def hourly(stream):
        return windows.tumbling(stream, "at", "1 hour", windows.measures(F.col("bad"), F.col("value")), late="2 hours")

    load(spark, str(tmp_path / "in"), [(1, 1, at(0.1), True, 1.5), (2, 1, at(1.9), False, 1.0), (9, 1, None, True, 1.0)])
    found, _ = run(spark, tmp_path, hourly)
    assert found.count() == 0
    # Late by less than two hours: counted. The next load closes the first hours, so id 5 comes too late.
    load(spark, str(tmp_path / "in"), [(3, 1, at(0.2), False, float("nan")), (4, 1, at(5.0), None, None)])
    found, _ = run(spark, tmp_path, hourly)
    rows = {r.window_start: r for r in found.collect()}
    assert set(rows) == {at(0), at(1)} and rows[at(0)].window_end == at(1)
    first = rows[at(0)]
    assert (first.rows, first.flagged, first.rate, first.total) == (2, 1, 0.5, 1.5)
    load(spark, str(tmp_path / "in"), [(5, 1, at(0.3), True, 9.0), (6, 1, at(20.0), True, 1.0)])
    found, progress = run(spark, tmp_path, hourly)
    state = [s for p in progress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert state[-1]["numRowsTotal"] == 1  # only the window of the latest event is still held
    assert sorted(r.window_start for r in found.collect()) == [at(0), at(1), at(5)]
    again, _ = run(spark, tmp_path, hourly)
    assert again.count() == 3


def test_sliding_windows_and_sessions(spark):
    rows = [(k, k % 2, at(h), False, 1.0) for k, h in enumerate([0, 0, 1, 2.5, 9, 9.5, 30])]
    frame = spark.createDataFrame([*rows, (9, None, at(1), True, 2.0)], SCHEMA)
    slid = windows.sliding(frame, "at", "4 hours", "2 hours", windows.measures()).collect()
    assert sum(r.rows for r in slid) == 2 * 8 and all(r.window_end - r.window_start == timedelta(hours=4) for r in slid)
    met = windows.sessions(frame, "at", "3 hours", windows.measures(), ["user"]).collect()
    assert sorted((str(r.user), r.rows, r.window_start) for r in met) == [
        ("0", 1, at(9)), ("0", 1, at(30)), ("0", 2, at(0)), ("1", 1, at(9.5)), ("1", 2, at(0)), ("None", 1, at(1)),
    ]
    with pytest.raises(ValueError):
        windows.sessions(frame, "at", "3 hours", windows.measures(), [])


def test_repeats_within_the_watermark_are_dropped_and_forgotten(spark, tmp_path):
    def once(stream):
        return windows.first_within(stream, ["id"], "at", "10 hours")

    load(spark, str(tmp_path / "in"), [(k, 1, at(k / 10), True, 1.0) for k in range(20)])
    run(spark, tmp_path, once)
    load(spark, str(tmp_path / "in"), [(k, 2, at(5 + k / 10), True, 2.0) for k in range(30)])
    found, _ = run(spark, tmp_path, once)
    assert sorted((r.id, r.user) for r in found.collect()) == [(k, 1 if k < 20 else 2) for k in range(30)]
    load(spark, str(tmp_path / "in"), [(100, 3, at(60), True, 1.0)])
    _, progress = run(spark, tmp_path, once)
    assert [s["numRowsTotal"] for p in progress for s in p["stateOperators"]][-1] == 1
    load(spark, str(tmp_path / "in"), [(0, 4, at(61), True, 1.0)])
    found, _ = run(spark, tmp_path, once)
    assert found.filter("id = 0").count() == 2  # long after its watermark a key is new


CLAIMS = "provider_specialty string, billed_amount double, is_rejected boolean"


def claims(seed, count=300):
    rng = random.Random(seed)
    return [
        (rng.choice(["a", "b", None, f"s{seed}"]), rng.choice([None, float("nan"), rng.randint(1, 10**6) / 100]), rng.random() < 0.3)
        for _ in range(count)
    ]


def assert_same_baselines(got, expected):
    key = lambda r: (r.level, str(r.provider_specialty))
    got, expected = sorted(got.collect(), key=key), sorted(expected.collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in expected] and len(got) > 4
    for a, b in zip(got, expected):
        assert a.claims == b.claims and a.rejection_rate == pytest.approx(b.rejection_rate)
        assert a.amount_mean == pytest.approx(b.amount_mean, abs=1e-4)
        assert a.amount_std == pytest.approx(b.amount_std, rel=1e-9)


def test_running_baselines_equal_those_of_all_claims_and_replays_change_nothing(spark, tmp_path):
    source, store, out = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "out")
    schema, seen = spark.createDataFrame([], CLAIMS).schema, []

    def go(checkpoint):
        stream = ingest.file_stream(spark, source, schema)
        baselines.running_baselines(stream, store, out, checkpoint, available_now=True).awaitTermination()

    for seed in range(4):
        rows = claims(seed)
        spark.createDataFrame(rows, CLAIMS).coalesce(1).write.mode("append").parquet(source)
        go(str(tmp_path / "cp"))
        before, seen = seen, seen + rows
        scored = spark.read.parquet(f"{out}/batch={seed}")
        if not before:
            assert scored.filter("billed_amount_zscore IS NOT NULL OR provider_specialty_risk IS NOT NULL").isEmpty()
            continue
        table = stats.settle(stats.claim_baselines(spark.createDataFrame(before, CLAIMS)))
        expected = stats.with_baselines(spark.createDataFrame(rows, CLAIMS), table)
        for name in ("billed_amount_zscore", "provider_specialty_risk"):
            ours, theirs = (f.agg(F.count(name), F.sum(name)).first() for f in (scored, expected))
            assert ours[0] == theirs[0] > 0 and ours[1] == pytest.approx(theirs[1], abs=1e-4)
    whole = stats.claim_baselines(spark.createDataFrame(seen, CLAIMS))
    assert_same_baselines(baselines.baselines(baselines.stored_moments(spark, store)), whole)
    assert baselines.versions(spark, store) == [1, 2, 3]
    # The last batch again, as after a failure before its commit was noted.
    commit = tmp_path / "cp" / "commits" / "3"
    commit.unlink()
    (tmp_path / "cp" / "commits" / ".3.crc").unlink(missing_ok=True)
    go(str(tmp_path / "cp"))
    assert baselines.versions(spark, store) == [1, 2, 3]
    assert_same_baselines(baselines.baselines(baselines.stored_moments(spark, store)), whole)
    assert spark.read.parquet(out).count() == len(seen)


def test_moments_of_empty_parts_and_single_rows(spark):
    none = baselines.moments(spark.createDataFrame([], CLAIMS))
    one = baselines.moments(spark.createDataFrame([("a", 5.0, True)], CLAIMS))
    both = baselines.merged(none, one)
    assert both.exceptAll(one).isEmpty() and baselines.merged(one, none).exceptAll(one).isEmpty()
    rows = {r.level: r for r in baselines.baselines(both).collect()}
    assert rows[0].amount_std is None and rows[1].amount_mean == 5.0 and rows[1].rejection_rate == 1.0


def plain_asof(left, right, strict):
    found = []
    for key, time, n in left:
        best = None
        if time is not None:
            for k, when, value in right:
                if k == key and when is not None and (when < time or (when == time and not strict)):
                    ranked = (when, value is not None, value or 0)
                    best = max(best, ranked) if best else ranked
        found.append((key, time, n, best[2] if best and best[1] else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_matches_plain_version(spark, strict):
    rng = random.Random(8)
    times = [at(24 * rng.randint(0, 200)) for _ in range(60)] + [None]
    left = [(rng.choice(["hot"] * 5 + ["b", None]), rng.choice(times), n) for n in range(400)]
    right = [(rng.choice(["hot", "b", None, "c"]), rng.choice(times), rng.choice([None, rng.randint(1, 9)])) for _ in range(60)]
    frames = (
        spark.createDataFrame(left, "k string, t timestamp, n int"),
        spark.createDataFrame(right, "k string, since timestamp, value int"),
    )
    got = asof_join(*frames, ["k"], "t", "since", ["value"], strict=strict)
    assert got.columns == ["k", "t", "n", "value"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_asof(left, right, strict)


def test_asof_join_splits_a_hot_key_and_refuses_clashes(spark):
    left = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 86_400).alias("t"))
    right = spark.range(0, 20_000, 7).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 86_400).alias("since"), F.col("id").alias("value")
    )
    got = asof_join(left, right, ["k"], "t", "since", ["value"])
    wrong = got.filter(F.col("value") != F.expr("unix_seconds(t) div 86400 div 7 * 7"))
    assert got.count() == 20_000 and wrong.isEmpty()
    # Windows are by key and range only; the one over whole keys has a row per range.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_span" in plan
    with pytest.raises(ValueError):
        asof_join(left.withColumn("value", F.lit(1)), right, ["k"], "t", "since", ["value"])
    assert asof_join(left.limit(0), right, ["k"], "t", "since", ["value"]).count() == 0
    assert asof_join(left, right.limit(0), ["k"], "t", "since", ["value"]).filter("value IS NOT NULL").isEmpty()


def test_removals_are_counted_once_per_batch(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "k long, n int"
    rules = {"n": F.col("n") > 0, "k": F.col("k").isNotNull()}

    def go():
        stream = ingest.file_stream(spark, source, spark.createDataFrame([], schema).schema)
        ingest.ingest_counted(
            stream, str(tmp_path / "out"), str(tmp_path / "counts"), str(tmp_path / "cp"), rules, available_now=True
        ).awaitTermination()

    for rows in ([(1, 1), (2, -1), (None, None)], [(3, 5)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        go()
    (tmp_path / "cp" / "commits" / "1").unlink()
    (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    go()
    found = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "counts")).select(
        "batch", "initial_rows", "kept_rows", "failed_n", "failed_k", "removed_rows").collect())
    assert found == [(0, 3, 1, 2, 1, 2), (1, 1, 1, 0, 0, 0)]
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3]


def test_sketches_of_days_merge_into_those_of_all_rows(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), (F.col("id") % 3).alias("g"), (F.col("id") % 20_011).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("w"),
    )
    daily = sketches.distinct_sketches(rows, ["day", "g"], ["v", "w"])
    whole = sketches.distinct_estimates(sketches.merged_sketches(daily, [], ["v", "w"]), ["v", "w"]).collect()
    assert [r.rows for r in whole] == [60_000] and abs(whole[0].v - 20_011) <= 600 and whole[0].w == 1
    none = sketches.distinct_estimates(sketches.distinct_sketches(rows.limit(0), [], ["v"]), ["v"]).collect()
    assert none[0].v == 0 and none[0].rows == 0
