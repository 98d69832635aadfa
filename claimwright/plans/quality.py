"""Validation, constraints, duplicates, applications, and table movement."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from claimwright.operators import applications as apps
from claimwright.operators import labels, quality, reports
from claimwright.plans import decisions, screening
from claimwright.plans import tables as t
from claimwright.session import scratch_path
from claimwright.sources import catalog, derived, readers, schemas, sinks
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"
AS_OF = datetime(2002, 1, 1)

# Gaps put into the clean claims, as SQL both engines read.
_GAPS = {
    "patient_id": "CASE WHEN ok % 89 <> 0 THEN patient_id END",
    "patient_age": "CASE WHEN pk % 37 = 0 THEN patient_age + 50 ELSE patient_age END",
    "billed_amount": "CASE WHEN pk % 53 = 0 THEN -billed_amount ELSE billed_amount END",
    "documentation_quality_score": "CASE WHEN ok % 31 = 0 THEN documentation_quality_score + 0.5e0 "
    "WHEN ok % 29 <> 0 THEN documentation_quality_score END",
}


def dirty_claims(spark, sf_dir):
    claims = labels.labelled_claims(labels.with_timing(derived.medical_claims(spark, sf_dir)))
    return claims.withColumns({name: F.expr(text) for name, text in _GAPS.items()})


_DIRTY_SQL = (
    t.over("mc", "")
    + ", dirty AS (SELECT * REPLACE ("
    + ", ".join(f"{text} AS {name}" for name, text in _GAPS.items())
    + "), isodow(submission_date) >= 6 AS is_weekend_submission, "
    "hour(submission_date) < 8 OR hour(submission_date) > 18 AS is_after_hours_submission "
    "FROM mc) "
)
_CLAIM_RULES = {
    "claim_id": "claim_id IS NOT NULL",
    "patient_id": "patient_id IS NOT NULL",
    "provider_id": "provider_id IS NOT NULL",
    "patient_age": "patient_age BETWEEN 0 AND 120",
    "billed_amount": "billed_amount > 0",
    "documentation_quality_score": "documentation_quality_score BETWEEN 0 AND 1",
}


def _removal_sql(rules: dict[str, str], source: str) -> str:
    every = " AND ".join(f"coalesce({r}, false)" for r in rules.values())
    failed = ", ".join(
        f"{t.count_if(f'NOT coalesce({rule}, false)')} AS failed_{name}"
        for name, rule in rules.items()
    )
    return (
        "SELECT *, initial_rows - kept_rows AS removed_rows FROM (SELECT count(*) AS initial_rows, "
        f"{t.count_if(every)} AS kept_rows, {failed} FROM {source})"
    )


def validate_claims(spark, sf_dir):
    return quality.validate_claims(dirty_claims(spark, sf_dir)).select(
        *ROW_KEYS, "patient_id", "patient_age", "billed_amount", *quality.CLAIM_FLAGS
    )


def claim_removals(spark, sf_dir):
    return quality.removal_counts(dirty_claims(spark, sf_dir), quality.claim_rules())


def quality_report(spark, sf_dir):
    return quality.quality_report(dirty_claims(spark, sf_dir), "medical_claims")


_LENGTHS = {
    "claim_id": 50, "patient_id": 50, "provider_id": 50, "patient_gender": 1, "policy_type": 10,
    "provider_specialty": 50, "provider_network_status": 20, "primary_diagnosis_code": 10,
    "procedure_code": 10, "claim_type": 20, "rejection_reason": 100,
}
_REQUIRED = [
    "claim_id", "patient_id", "provider_id", "service_date", "submission_date", "is_rejected",
]
_RANGES = {
    "billed_amount": (8, 2), "amount_per_age": (8, 2), "patient_rejection_rate": (2, 3),
    "documentation_quality_score": (1, 3), "risk_score": (1, 3),
}


def _report_sql() -> str:
    tests = [(c, "not_null", f"{c} IS NULL") for c in _REQUIRED]
    tests += [(c, "max_length", f"length({c}) > {n}") for c, n in _LENGTHS.items()]
    tests += [
        (c, "range", f"abs({t.half_up(c, scale)}) >= 1e{digits}")
        for c, (digits, scale) in _RANGES.items()
    ]
    return " UNION ALL ".join(
        f"SELECT 'medical_claims' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
        f"{t.count_if(test)} AS violations FROM dirty"
        for c, rule, test in tests
    )


def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(derived.medical_claims(spark, sf_dir), ["claim_id"])


def first_claims(spark, sf_dir):
    claims = derived.medical_claims(spark, sf_dir).select(*ROW_KEYS, "claim_id", "billed_amount")
    return quality.keep_first(claims, ["claim_id"], ROW_KEYS)


def duplicate_claims(spark, sf_dir):
    claims = derived.medical_claims(spark, sf_dir).select(*ROW_KEYS, *quality.DUPLICATE_KEY)
    return quality.duplicate_claims(claims, order=ROW_KEYS)


def denial_actions(spark, sf_dir):
    decided = decisions.rejection_reason_counts(spark, sf_dir)
    return quality.with_denial_action(decided).select(
        "rejection_reason", "claims", "issue", "denial_check", "denial_action"
    )


def optional_projection(spark, sf_dir):
    """The listed columns that the table has, in list order."""
    claims = derived.medical_claims(spark, sf_dir)
    wanted = [*ROW_KEYS, "patient_age", "copay_amount", "billed_amount", "deductible_amount"]
    return claims.select([c for c in wanted if c in claims.columns])


def profile_counts(spark, sf_dir):
    return catalog.profile_counts(dirty_claims(spark, sf_dir), "service_date")


_PROFILED = ["claim_id", "patient_id", "patient_age", "billed_amount", "rejection_reason"]


def profile_columns(spark, sf_dir):
    return catalog.profile_columns(dirty_claims(spark, sf_dir).select(*_PROFILED))


def conformed_claims(spark, sf_dir):
    """Stored form of the scored claims, with decimals at their stored scale."""
    claims = labels.with_timing(screening.with_baselines(spark, sf_dir)).withColumn(
        "claim_id", F.expr("concat(claim_id, '-', pk, '-', sk)")
    )
    stored = schemas.conform(claims, "medical_claims", with_audit=False)
    return stored.select(
        "claim_id",
        F.col("submission_date").cast("timestamp_ntz").alias("submission_date"),
        *[
            F.col(c).cast("double").alias(c)
            for c in (
                "billed_amount",
                "amount_per_age",
                "billed_amount_zscore",
                "provider_specialty_risk",
                "risk_score",
                "copay_amount",
            )
        ],
    )


def table_reconcile(spark, sf_dir):
    """Copy the conformed claims to a second table and compare the two."""
    source = schemas.conform(decisions.labelled(spark, sf_dir), "bpo_claims_training", False)
    target = sinks.copy_table(source, scratch_path(spark, "copied"))
    return sinks.reconcile(source, target, ["claim_id"])


def csv_round_trip(spark, sf_dir):
    """Training claims written as compressed CSV and read back with dates parsed and nulls filled."""
    path = scratch_path(spark, "training-csv")
    claims = schemas.conform(decisions.labelled(spark, sf_dir), "bpo_claims_training", False)
    sinks.write_csv(claims, path, compression="gzip")
    back = readers.read_training_csv(spark, path)
    return back.groupBy("rejection_category").agg(
        F.count(F.lit(1)).alias("claims"),
        F.min("service_date").alias("first_service"),
        F.max("submission_date").alias("last_submission"),
        F.sum("days_to_decision").alias("filled_days"),
        F.count("rejection_reason").alias("reasons"),
        reports.exact_sum(F.col("billed_amount")).alias("billed"),
        F.count_if("is_approved").alias("approved"),
    )


# ---- applications ----------------------------------------------------------------------


def _raw(spark, sf_dir):
    return derived.raw_applications(spark, sf_dir)


def validate_applications(spark, sf_dir):
    return apps.validate_applications(_raw(spark, sf_dir))


def application_removals(spark, sf_dir):
    numeric = apps.to_numbers(_raw(spark, sf_dir).drop("c_custkey"))
    return quality.removal_counts(numeric, apps.application_rules(numeric))


def _backfilled(spark, sf_dir):
    raw = apps.normalize_categories(apps.to_numbers(_raw(spark, sf_dir)))
    return apps.backfill(raw, AS_OF)


def backfill_applications(spark, sf_dir):
    return _backfilled(spark, sf_dir)


def numbered_applications(spark, sf_dir):
    """Backfill of an absent customer_id by row number."""
    raw = apps.normalize_categories(apps.to_numbers(_raw(spark, sf_dir))).drop("customer_id")
    filled = apps.backfill(raw, AS_OF, order=["c_custkey"])
    return filled.select("c_custkey", "customer_id", "gender", "annual_income")


def application_stats(spark, sf_dir):
    return reports.application_stats(_backfilled(spark, sf_dir))


def expected_charges(spark, sf_dir):
    valid = apps.with_expected_charges(apps.validate_applications(_raw(spark, sf_dir)))
    return valid.select("c_custkey", "expected_charges", "charge_gap")


def medical_history(spark, sf_dir):
    valid = apps.validate_applications(_raw(spark, sf_dir))
    return valid.select("c_custkey", apps.medical_history().alias("medical_history"))


_FEATURES = [
    "bmi_category",
    "gender_encoded",
    "smoker_encoded",
    "region_encoded",
    "bmi_category_encoded",
    "risk_score",
    "income_to_charges_ratio",
]


def application_features(spark, sf_dir):
    valid = apps.backfill(apps.validate_applications(_raw(spark, sf_dir)), AS_OF)
    return apps.with_features(valid).select("c_custkey", *_FEATURES)


_APPLICATION_RULES = {
    **{f"{c}_present": f"{c} IS NOT NULL" for c in ("customer_id", "age", "sex", "children", "smoker", "region", "charges")},
    "bmi_present": "try_cast(bmi AS DOUBLE) IS NOT NULL",
    "age_range": "age BETWEEN 18 AND 100",
    "bmi_range": "try_cast(bmi AS DOUBLE) BETWEEN 15 AND 50",
    "charges_positive": "charges > 0",
    "children_range": "children BETWEEN 0 AND 10",
}
_STAMP = "TIMESTAMP '2002-01-01' AS application_date"
_FIRST = "row_number() OVER (PARTITION BY claim_id ORDER BY ok, ln, pk, sk, billed_amount)"

QUERIES = {
    "validate_claims": (
        validate_claims,
        _DIRTY_SQL
        + f"SELECT {_KEYS}, patient_id, patient_age, billed_amount, "
        + ", ".join(quality.CLAIM_FLAGS)
        + " FROM dirty WHERE "
        + " AND ".join(_CLAIM_RULES.values()),
    ),
    "claim_removals": (claim_removals, _DIRTY_SQL + _removal_sql(_CLAIM_RULES, "dirty")),
    "quality_report": (quality_report, _DIRTY_SQL + _report_sql()),
    "duplicate_keys": (
        duplicate_keys,
        t.over("mc0", "SELECT claim_id, count(*) AS copies FROM mc0 GROUP BY 1 HAVING count(*) > 1"),
    ),
    "first_claims": (
        first_claims,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, claim_id, billed_amount FROM (SELECT *, {_FIRST} AS rn FROM mc0) "
            "WHERE rn = 1",
        ),
    ),
    "duplicate_claims": (
        duplicate_claims,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, patient_id, provider_id, service_date, procedure_code, copies, "
            "row(ok, ln, pk, sk) <> lowest AS is_repeat FROM (SELECT *, count(*) OVER w AS copies, "
            "min(row(ok, ln, pk, sk)) OVER w AS lowest FROM mc0 WINDOW w AS "
            "(PARTITION BY patient_id, provider_id, service_date, procedure_code)) "
            "WHERE copies > 1",
        ),
    ),
    "denial_actions": (
        denial_actions,
        t.over("cd", "")
        + ", r AS (SELECT rejection_reason, count(*) AS claims FROM (SELECT "
        + decisions._REASON
        + " AS rejection_reason FROM cd) WHERE rejection_reason IS NOT NULL GROUP BY 1) "
        "SELECT r.rejection_reason, r.claims, d.issue, d.denial_check, d.denial_action FROM r "
        "LEFT JOIN (VALUES ('missing_prior_authorization', 'missing_authorization', "
        "'pre_auth_required', 'Obtain pre-authorization before submission'), "
        "('eligibility_verification_failed', 'eligibility_issue', 'patient_eligibility', "
        "'Verify patient insurance eligibility'), "
        "('insufficient_documentation', 'missing_documentation', 'documentation_completeness', "
        "'Request missing documents from provider'), "
        "('incorrect_coding', 'incorrect_coding', 'coding_accuracy_score', "
        "'Review coding with certified coder'), "
        "('medical_necessity_not_established', 'medical_necessity', 'medical_necessity_score', "
        "'Obtain physician notes supporting necessity')) "
        "d(reason, issue, denial_check, denial_action) ON r.rejection_reason = d.reason",
    ),
    "optional_projection": (
        optional_projection,
        t.over("mc0", f"SELECT {_KEYS}, patient_age, billed_amount FROM mc0"),
    ),
    "profile_counts": (
        profile_counts,
        _DIRTY_SQL
        + "SELECT count(*) AS total_records, min(service_date) AS earliest, "
        "max(service_date) AS latest FROM dirty",
    ),
    "profile_columns": (
        profile_columns,
        _DIRTY_SQL
        + " UNION ALL ".join(
            f"SELECT {i + 1} AS position, '{c}' AS column_name, '{kind}' AS data_type, "
            f"count({c}) AS non_null FROM dirty"
            for i, (c, kind) in enumerate(
                zip(_PROFILED, ["string", "string", "int", "double", "string"])
            )
        ),
    ),
    "conformed_claims": (
        conformed_claims,
        t.over(
            "mcz",
            "SELECT concat(claim_id, '-', pk, '-', sk) AS claim_id, submission_date, "
            f"{t.half_up('billed_amount', 2)} AS billed_amount, amount_per_age, "
            f"{t.half_up('billed_amount_zscore', 6)} AS billed_amount_zscore, "
            f"{t.half_up('provider_specialty_risk', 3)} AS provider_specialty_risk, "
            "risk_score, CAST(NULL AS DOUBLE) AS copay_amount FROM mcz",
        ),
    ),
    "table_reconcile": (
        table_reconcile,
        "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) "
        "AS missing_keys, CAST(0 AS BIGINT) AS extra_keys, CAST(0 AS BIGINT) AS differing_keys, "
        "true AS matches FROM lineitem",
    ),
    "csv_round_trip": (
        csv_round_trip,
        t.over(
            "ct_cat",
            "SELECT rejection_category, count(*) AS claims, min(service_date) AS first_service, "
            "max(submission_date) AS last_submission, CAST(0 AS BIGINT) AS filled_days, "
            "count(rejection_reason) AS reasons, "
            f"{t.exact_sum(t.half_up('billed_amount', 2))} AS billed, "
            f"{t.count_if('is_approved')} AS approved FROM ct_cat GROUP BY 1",
        ),
    ),
    "validate_applications": (
        validate_applications,
        t.over("rav", "SELECT * FROM rav"),
    ),
    "application_removals": (
        application_removals,
        t.over("ra", _removal_sql(_APPLICATION_RULES, "ra")),
    ),
    "backfill_applications": (
        backfill_applications,
        t.over(
            "ra",
            "SELECT c_custkey, customer_id, CAST(age AS DOUBLE) AS age, lower(sex) AS gender, "
            "try_cast(bmi AS DOUBLE) AS bmi, children, lower(smoker) AS smoker, "
            "lower(region) AS region, charges, 'none' AS medical_history, "
            "'unknown' AS employment_status, charges * 4e0 AS annual_income, "
            f"{_STAMP} FROM ra",
        ),
    ),
    "numbered_applications": (
        numbered_applications,
        t.over(
            "ra",
            "SELECT c_custkey, concat('CUST_', lpad(CAST(row_number() OVER (ORDER BY c_custkey) - 1 "
            "AS VARCHAR), 6, '0')) AS customer_id, lower(sex) AS gender, "
            "charges * 4e0 AS annual_income FROM ra",
        ),
    ),
    "application_stats": (
        application_stats,
        t.over(
            "ra",
            "SELECT count(*) AS total_records, TIMESTAMP '2002-01-01' AS earliest_date, "
            "TIMESTAMP '2002-01-01' AS latest_date, "
            f"{t.half_up('avg(CAST(age AS DOUBLE))', 1)} AS avg_age, "
            f"{t.half_up(t.exact_mean('charges'), 2)} AS avg_charges FROM ra",
        ),
    ),
    "expected_charges": (
        expected_charges,
        t.over(
            "rav",
            "SELECT c_custkey, expected_charges, charges - expected_charges AS charge_gap FROM "
            "(SELECT *, greatest(500e0, 1000e0 + age * 20e0 + greatest(0e0, (bmi - 25e0) * 50e0) "
            "+ CASE WHEN smoker = 'yes' THEN 20000e0 ELSE 0e0 END + children * 500e0) "
            "AS expected_charges FROM rav)",
        ),
    ),
    "medical_history": (
        medical_history,
        t.over(
            "rav",
            "SELECT c_custkey, coalesce(nullif(concat_ws(', ', CASE WHEN smoker = 'yes' "
            "THEN 'smoker' END, CASE WHEN bmi > 30 THEN 'obesity' END, "
            "CASE WHEN age > 60 THEN 'senior' END), ''), 'none') AS medical_history FROM rav",
        ),
    ),
    "application_features": (
        application_features,
        t.over(
            "rav",
            "SELECT c_custkey, CASE WHEN bmi < 18.5e0 THEN 'underweight' WHEN bmi < 25 "
            "THEN 'normal' WHEN bmi < 30 THEN 'overweight' ELSE 'obese' END AS bmi_category, "
            "CASE gender WHEN 'female' THEN 0 ELSE 1 END AS gender_encoded, "
            "CASE smoker WHEN 'no' THEN 0 ELSE 1 END AS smoker_encoded, "
            "CASE region WHEN 'northeast' THEN 0 WHEN 'northwest' THEN 1 WHEN 'southeast' THEN 2 "
            "ELSE 3 END AS region_encoded, CASE WHEN bmi < 18.5e0 THEN 3 WHEN bmi < 25 THEN 0 "
            "WHEN bmi < 30 THEN 2 ELSE 1 END AS bmi_category_encoded, "
            "CASE WHEN smoker = 'yes' THEN 1 ELSE 0 END + CASE WHEN bmi > 30 THEN 1 ELSE 0 END "
            "+ CASE WHEN age > 60 THEN 1 ELSE 0 END AS risk_score, "
            "charges * 4e0 / charges AS income_to_charges_ratio FROM rav",
        ),
    ),
}
