"""Loading tables: batches, a fallback source, constraints, reconciliation of a copy, payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.operators import quality, training
from claimwright.plans import decisions
from claimwright.plans import tables as t
from claimwright.session import scratch_path
from claimwright.sources import derived, published, readers, schemas, sinks
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"


def _training(spark, sf_dir):
    return decisions.labelled(spark, sf_dir)


def append_batches(spark, sf_dir):
    """Two halves of the claims appended as batches, one of them twice, and read back."""
    claims = _training(spark, sf_dir)
    path = scratch_path(spark, "appended")
    halves = {"even": "ok % 2 = 0", "odd": "ok % 2 = 1"}
    for batch in ("even", "odd", "even"):
        sinks.append_batch(claims.filter(halves[batch]), path, batch, "bpo_claims_training")
    try:
        sinks.append_batch(claims.filter("ok < 0"), path, "none", "bpo_claims_training")
        refused = False
    except ValueError:
        refused = True
    back = published.read_published(spark, path)
    return back.groupBy("batch").agg(
        F.count(F.lit(1)).alias("claims"),
        F.sum("billed_amount").cast("double").alias("billed"),
        F.max("service_date").cast("timestamp_ntz").alias("last_service"),
        F.lit(refused).alias("empty_refused"),
    )


def resumed_copy(spark, sf_dir):
    """A copy in key ranges that stops after the second range, and goes on later with what is left."""
    claims = _training(spark, sf_dir)
    path = scratch_path(spark, "ranges")
    last = claims.agg(F.max("ok")).first()[0]
    bounds = [last * k // 4 for k in (1, 2, 3)]
    first = published.copy_ranges(claims, path, "ok", bounds, "bpo_claims_training", most=2)
    rest = published.copy_ranges(claims, path, "ok", bounds, "bpo_claims_training")
    back = published.read_published(spark, path)
    parts = F.when(F.col("batch").isin(rest), 2).when(F.col("batch").isin(first), 1)
    return back.groupBy(parts.alias("run")).agg(
        F.count(F.lit(1)).alias("claims"),
        F.count_distinct("batch").alias("ranges"),
        F.sum("billed_amount").cast("double").alias("billed"),
    )


def applications_fallback(spark, sf_dir):
    """An applications file without rows: the given customers stand in for it."""
    path = scratch_path(spark, "applications")
    empty = spark.createDataFrame([], readers.PUBLIC_APPLICATIONS)
    sinks.write_csv(empty, path)
    return readers.read_applications(spark, path, derived.raw_applications(spark, sf_dir))


def table_reconcile_gaps(spark, sf_dir):
    """A copy that lacks some claims and has others under changed keys."""
    source = _training(spark, sf_dir)
    changed = F.expr("CASE WHEN ok % 70 = 1 THEN concat(claim_id, 'X') ELSE claim_id END")
    copied = source.filter("ok % 50 <> 0").withColumn("claim_id", changed)
    target = sinks.copy_table(
        schemas.conform(copied, "bpo_claims_training", False), scratch_path(spark, "copied")
    )
    return sinks.reconcile(source.select("claim_id"), target, ["claim_id"])


def training_payments(spark, sf_dir):
    """Payments of approved claims whose expected money is near the billed amount.

    The variance of 0.85 to 1.05 comes from a draw, so that the billed amount binds for some.
    """
    claims = training.with_approval_label(decisions.base(spark, sf_dir)).withColumn(
        "expected_reimbursement", F.col("billed_amount") * 0.98
    )
    paid = training.with_outcomes(claims, F.lit(0.85) + F.col("u_reason") * 0.2)
    return paid.select(*ROW_KEYS, "final_payment_amount")


# Faults put into the clean tables, as SQL that both engines read.
_FAULTS = {
    "bpo_claims_training": {
        "claim_id": "CASE WHEN ok % 89 <> 0 THEN claim_id END",
        "billed_amount": "CASE WHEN pk % 53 = 0 THEN billed_amount * 1e7 ELSE billed_amount END",
        "provider_specialty": "CASE WHEN sk % 7 = 0 THEN repeat(provider_specialty, 5) "
        "ELSE provider_specialty END",
    },
    "bpo_claims_processing": {
        "client_provider_id": "CASE WHEN sk % 11 <> 0 THEN client_provider_id END",
        "raw_provider_charges": "CASE WHEN pk % 53 = 0 THEN raw_provider_charges * 1e7 "
        "ELSE raw_provider_charges END",
        "payor_relationship_tier": "CASE WHEN sk % 5 = 0 THEN repeat(payor_relationship_tier, 2) "
        "ELSE payor_relationship_tier END",
    },
    "raw_applications": {
        "smoker": "CASE WHEN c_custkey % 7 = 0 THEN repeat(smoker, 6) ELSE smoker END",
        "region": "CASE WHEN c_custkey % 11 = 0 THEN repeat(region, 3) ELSE region END",
    },
}
_SOURCES = {
    "bpo_claims_training": (
        lambda spark, sf_dir: derived.claims_training(spark, sf_dir, state=True),
        "ct0",
        derived.CLAIMS_TRAINING,
    ),
    "bpo_claims_processing": (derived.claims_processing, "cp0", derived.CLAIMS_PROCESSING),
    "raw_applications": (derived.raw_applications, "ra", derived.RAW_APPLICATIONS),
}


def _report(table):
    def run(spark, sf_dir):
        frame = _SOURCES[table][0](spark, sf_dir)
        return quality.quality_report(
            frame.withColumns({n: F.expr(text) for n, text in _FAULTS[table].items()}), table
        )

    return run


def _report_sql(table):
    _, name, columns = _SOURCES[table]
    tests = []
    for f in schemas.fields(table):
        if f.name not in columns:
            continue
        if f.required:
            tests.append((f.name, "not_null", f"{f.name} IS NULL"))
        if f.kind == "VARCHAR":
            tests.append((f.name, "max_length", f"length({f.name}) > {f.size}"))
        if f.kind == "DECIMAL":
            rounded = t.half_up(f"CAST({f.name} AS DOUBLE)", f.scale)
            tests.append((f.name, "range", f"abs({rounded}) >= 1e{f.size - f.scale}"))
    faults = ", ".join(f"{text} AS {n}" for n, text in _FAULTS[table].items())
    counts = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
        f"{t.count_if(test)} AS violations FROM faulty"
        for c, rule, test in tests
    )
    return t.over(name, "") + f", faulty AS (SELECT * REPLACE ({faults}) FROM {name}) {counts}"


QUERIES = {
    "quality_report_training": (
        _report("bpo_claims_training"),
        _report_sql("bpo_claims_training"),
    ),
    "quality_report_processing": (
        _report("bpo_claims_processing"),
        _report_sql("bpo_claims_processing"),
    ),
    "quality_report_applications": (
        _report("raw_applications"),
        _report_sql("raw_applications"),
    ),
    "append_batches": (
        append_batches,
        t.over(
            "ct",
            "SELECT CASE WHEN ok % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, count(*) AS claims, "
            f"CAST(sum(CAST({t.half_up('billed_amount', 2)} AS DECIMAL(18, 2))) AS DOUBLE) AS billed, "
            "max(service_date) AS last_service, true AS empty_refused FROM ct GROUP BY 1",
        ),
    ),
    "resumed_copy": (
        resumed_copy,
        t.over(
            "ct",
            "SELECT CASE WHEN ok < m * 2 // 4 THEN 1 ELSE 2 END AS run, count(*) AS claims, "
            "count(DISTINCT CASE WHEN ok < m // 4 THEN 0 WHEN ok < m * 2 // 4 THEN 1 WHEN ok < m * 3 // 4 THEN 2 "
            "ELSE 3 END) AS ranges, "
            f"CAST(sum(CAST({t.half_up('billed_amount', 2)} AS DECIMAL(18, 2))) AS DOUBLE) AS billed "
            "FROM ct, (SELECT max(ok) AS m FROM ct) GROUP BY 1",
        ),
    ),
    "applications_fallback": (applications_fallback, t.over("ra", "SELECT * FROM ra")),
    "table_reconcile_gaps": (
        table_reconcile_gaps,
        t.over(
            "ct",
            "SELECT CAST(sum(n) AS BIGINT) AS source_rows, CAST(sum(m) AS BIGINT) AS target_rows, "
            f"{t.count_if('m = 0')} AS missing_keys, {t.count_if('n = 0')} AS extra_keys, "
            f"{t.count_if('n <> m')} AS differing_keys, "
            "sum(n) = sum(m) AND count(*) FILTER (WHERE n <> m) = 0 AS matches FROM ("
            "SELECT claim_id, sum(n) AS n, sum(m) AS m FROM (SELECT claim_id, 1 AS n, 0 AS m FROM ct "
            "UNION ALL SELECT CASE WHEN ok % 70 = 1 THEN concat(claim_id, 'X') ELSE claim_id END, "
            "0, 1 FROM ct WHERE ok % 50 <> 0) GROUP BY 1)",
        ),
    ),
    "training_payments": (
        training_payments,
        t.over(
            "ct",
            f"SELECT {_KEYS}, CASE WHEN is_approved THEN "
            f"{t.half_up('least(billed_amount * 0.98e0 * (0.85e0 + u_reason * 0.2e0), billed_amount)', 2)} "
            "ELSE 0e0 END AS final_payment_amount FROM ct",
        ),
    ),
}
