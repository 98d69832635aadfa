"""Skewed keys, lookups on both join paths, order-independent sums, row numbers."""

import random

from pyspark.sql import functions as F

from claimwright.functions import exact_mean, exact_sum, half_up, share
from claimwright.operators import applications, features, history, quality, training
from claimwright.operators import statistics as stats
from claimwright.sources import derived
from claimwright.session import (
    JIT_BYTES,
    attach_lookup,
    discard_settled,
    salted_left_join,
    settle,
    shared_dir,
)


def _skewed(spark, rows=3000):
    rng = random.Random(3)
    data = [
        (i, "hot" if i % 3 == 0 else f"k{rng.randrange(50)}" if i % 17 else None, float(i % 101))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "id long, key string, value double").repartition(6)


def test_half_up_and_sums(spark):
    row = spark.createDataFrame([(0.125, 2.5, -1.5)], "a double, b double, c double").select(
        half_up(F.col("a"), 2), half_up(F.col("b"), 0), half_up(F.col("c"), 0)
    ).first()
    assert tuple(row) == (0.13, 3.0, -1.0)
    values = [(0.1 * i, i) for i in range(5000)]
    frame = spark.createDataFrame(values, "x double, i int")
    sums = {
        frame.repartition(n).agg(exact_sum(F.col("x")).alias("s")).first().s for n in (1, 3, 8)
    }
    assert len(sums) == 1
    empty = frame.filter("i < 0").agg(exact_mean(F.col("x")).alias("m"), F.count("*").alias("n"))
    assert empty.first().m is None
    assert empty.select(share(F.col("n"), F.col("n")).alias("s")).first().s == 0.0


def test_large_totals_do_not_overflow(spark):
    frame = spark.range(20000).select(F.lit(9e10).alias("x"))
    total = frame.agg(exact_sum(F.col("x")).alias("s")).first().s
    assert total == 9e10 * 20000


def test_lookup_paths_agree(spark):
    frame = _skewed(spark)
    lookup = frame.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))
    small = attach_lookup(frame, lookup, ["key"])
    large = attach_lookup(frame, lookup, ["key"], max_rows=5)
    hot = salted_left_join(frame, settle(lookup), ["key"], salts=4, hot_rows=100)
    assert "strategy=broadcast" in small._jdf.queryExecution().toString()
    assert "strategy=broadcast" not in large._jdf.queryExecution().toString()
    expected = sorted(map(repr, small.collect()))
    assert expected == sorted(map(repr, large.collect())) == sorted(map(repr, hot.collect()))
    assert small.count() == frame.count()
    assert small.filter(F.col("key").isNull() & F.col("n").isNotNull()).isEmpty()


def test_only_hot_keys_are_repeated(spark):
    frame = _skewed(spark)
    lookup = settle(
        frame.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = salted_left_join(frame, lookup, ["key"], salts=8, hot_rows=500)
        tasks = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("p"))
        assert joined.filter("key = 'hot'").count() == 1000
        assert tasks.distinct().count() > 1
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_shared_dir_follows_the_session(spark):
    folder = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert shared_dir(spark) == folder
    kept = settle(spark.range(10).filter("id > 3"))
    assert kept.count() == 6 and "parquet" in kept._jdf.queryExecution().toString().lower()


def test_dense_ids(spark):
    rng = random.Random(5)
    keys = [rng.randrange(40) if i % 3 else 7 for i in range(2000)]
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(5)
    got = applications.dense_ids(frame, ["k"], "n").select("n", "k").collect()
    assert sorted(r.n for r in got) == list(range(2000))
    ordered = [r.k for r in sorted(got, key=lambda r: r.n)]
    assert ordered == sorted(keys)


def test_keep_first_and_duplicates_on_a_hot_key(spark):
    frame = _skewed(spark).fillna("none", ["key"])
    kept = quality.keep_first(frame, ["key"], ["id"]).collect()
    first = {}
    for row in frame.collect():
        first[row.key] = min(first.get(row.key, row.id), row.id)
    assert {r.key: r.id for r in kept} == first
    marked = quality.duplicate_claims(frame, ["key"], ["id"])
    repeats = marked.filter("is_repeat").count()
    alone = frame.groupBy("key").count().filter("count = 1").count()
    assert repeats == frame.count() - len(first)
    assert marked.count() == frame.count() - alone


def test_statistics_edge_cases(spark):
    schema = "provider_specialty string, billed_amount double, is_rejected boolean"
    one = spark.createDataFrame([("a", 5.0, True)], schema)
    row = stats.with_baselines(one).first()
    assert row.billed_amount_zscore is None and row.provider_specialty_risk == 1.0
    equal = spark.createDataFrame([("a", 5.0, True), (None, 5.0, False)], schema)
    found = {r.provider_specialty: r for r in stats.with_baselines(equal).collect()}
    assert found["a"].billed_amount_zscore is None
    assert found[None].provider_specialty_risk is None


def test_null_group_is_not_the_total(spark):
    schema = "provider_specialty string, billed_amount double, is_rejected boolean"
    rows = [(None, 100.0, True)] * 3 + [("a", 1.0, False), ("a", 3.0, True)]
    claims = spark.createDataFrame(rows, schema)
    got = stats.with_baselines(claims).filter("provider_specialty = 'a'").collect()
    assert {r.provider_specialty_risk for r in got} == {0.5}
    mean = sum(r[1] for r in rows) / 5
    std = (sum((r[1] - mean) ** 2 for r in rows) / 4) ** 0.5
    assert abs(min(r.billed_amount_zscore for r in got) - (1.0 - mean) / std) < 1e-12


def test_provider_network_counts_links_without_pairs(spark):
    seen = [("p1", "a"), ("p1", "b"), ("p1", "b"), ("p2", "a"), ("p3", "a"), ("p3", "b"), ("p3", "c")]
    claims = spark.createDataFrame(seen, "patient_id string, provider_id string")
    got = {r.provider_id: (r.patients, r.shared_patients, r.links) for r in history.provider_network(claims).collect()}
    pairs = set(seen)
    for provider in "abc":
        patients = {p for p, d in pairs if d == provider}
        links = sum(1 for p, d in pairs if p in patients and d != provider)
        shared = sum(any(q == p and d != provider for q, d in pairs) for p in patients)
        assert got[provider] == (len(patients), shared, links)


def test_moves(spark):
    rows = [("p", "2020-01-01", "A"), ("p", "2020-01-05", "B"), ("p", "2020-01-05", "B"), ("p", "2020-02-01", "A")]
    claims = spark.createDataFrame(rows, "patient_id string, service_date string, place string")
    row = history.geographic_movement(claims, "place").first()
    assert (row.claim_days, row.moves) == (3, 2)


def test_split_shares_and_stability(spark):
    frame = spark.range(20000).select("id", (F.col("id") % 7 == 0).alias("label"))
    flagged = features.split_flag(frame, features.hash_bucket("id"), "label")
    for row in flagged.groupBy("label").agg(F.avg(F.col("is_train").cast("int")).alias("r")).collect():
        assert 0.79 < row.r < 0.82
    again = features.split_flag(frame.repartition(9), features.hash_bucket("id"), "label")
    assert flagged.exceptAll(again).isEmpty()
    plain = features.split_flag(frame, features.hash_bucket("id"))
    assert 0.79 < plain.agg(F.avg(F.col("is_train").cast("int"))).first()[0] < 0.82


def test_reason_weights_and_pick(spark):
    schema = (
        "network_status string, prior_authorization_obtained boolean, "
        "eligibility_verification_completed boolean, provider_data_completeness double, "
        "coding_accuracy_score double, days_service_to_submission int, is_approved boolean, "
        "u_reason double"
    )
    rows = [
        ("In-Network", True, True, 0.9, 0.95, 10, False, 0.0),
        ("In-Network", True, True, 0.9, 0.95, 10, False, 0.15),
        ("In-Network", True, True, 0.9, 0.95, 10, False, 0.999),
        ("In-Network", True, True, 0.9, 0.95, 10, True, 0.5),
        ("Out-of-Network", False, False, 0.5, 0.8, 70, False, 0.5),
    ]
    claims = spark.createDataFrame(rows, schema)
    got = [r.rejection_reason for r in training.with_reason(claims).collect()]
    # A draw equal to a running weight takes the next reason.
    assert got[:4] == [
        "medical_necessity_not_established",
        "insufficient_documentation",
        "provider_contract_terminated",
        None,
    ]
    weights = training.reason_weight_rows(claims.limit(1), ["u_reason"])
    assert abs(weights.agg(F.sum("weight")).first()[0] - 1.0) < 1e-12
    assert weights.count() == 16


def test_null_safe_lookup(spark):
    frame = _skewed(spark)
    lookup = frame.groupBy("key").agg(F.count("*").alias("n"))
    small = attach_lookup(frame, lookup, ["key"], null_safe=True)
    large = attach_lookup(frame, lookup, ["key"], max_rows=5, null_safe=True)
    assert small.columns == [*frame.columns, "n"]
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    nulls = frame.filter("key is null").count()
    assert nulls and small.filter(f"key is null and n = {nulls}").count() == nulls


def test_settled_tables_can_be_discarded(spark, tmp_path):
    session = spark.newSession()
    kept = settle(session.range(5), "kept")
    assert kept.count() == 5 and discard_settled(session) == 1 and discard_settled(session) == 0


def test_nan_amounts_are_unknown(spark):
    rows = [("a", 100.0), ("a", 200.0), ("a", float("nan")), ("b", 300.0), ("b", None)]
    claims = spark.createDataFrame(rows, "provider_specialty string, billed_amount double")
    claims = claims.withColumn("is_rejected", F.lit(False))
    base = stats.claim_baselines(claims)
    scored = stats.with_zscore(claims, base).collect()
    assert sorted(r.billed_amount_zscore for r in scored if r.billed_amount_zscore is not None) == [-1, 0, 1]
    means = claims.groupBy("provider_specialty").agg(exact_mean(F.col("billed_amount")).alias("m"))
    assert {r[0]: r[1] for r in means.collect()} == {"a": 150.0, "b": 300.0}


def test_scans_of_the_claims(spark, sf_dir):
    """Two scans of the claim lines where a whole-table statistic is needed, no more."""
    from claimwright.plans import registry

    for name in ("billed_zscore", "amount_norms"):
        frame = registry.queries()[name](spark, sf_dir)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("lineitem.parquet") <= 1, name


def test_claims_do_not_run_in_methods_that_are_only_interpreted(spark, sf_dir):
    name = "spark.sql.codegen.hugeMethodLimit"
    for given, kept in (("65535", JIT_BYTES), ("4000", 4000)):
        spark.conf.set(name, given)
        try:
            derived.claims_training(spark, sf_dir)
            assert int(spark.conf.get(name)) == kept
        finally:
            spark.conf.set(name, str(JIT_BYTES))
