"""Labels and derived features of the training claims table."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule, Scorecard, half_up
from claimwright.operators.labels import OUT_OF_NETWORK, after_hours, weekend
from claimwright.sources.derived import submission_time

# Rejection reasons with base weights, in order, by category.
REASON_WEIGHTS = {
    "medical_clinical": {
        "medical_necessity_not_established": 0.15,
        "insufficient_documentation": 0.12,
        "diagnosis_procedure_mismatch": 0.08,
        "experimental_investigational": 0.05,
    },
    "administrative": {
        "missing_prior_authorization": 0.10,
        "eligibility_verification_failed": 0.08,
        "timely_filing_limit_exceeded": 0.06,
        "duplicate_claim_submission": 0.06,
    },
    "coding_billing": {
        "incorrect_procedure_code": 0.08,
        "incorrect_diagnosis_code": 0.06,
        "missing_required_modifiers": 0.04,
        "bundling_edits_violation": 0.02,
    },
    "provider_network": {
        "out_of_network_provider": 0.04,
        "provider_not_credentialed": 0.03,
        "invalid_provider_npi": 0.02,
        "provider_contract_terminated": 0.01,
    },
}
COMPLEX_DIAGNOSES = ["E11.9", "I10", "J44.1"]
HIGH_DOLLAR = 5000


def approval_card(inputs: Inputs) -> Scorecard:
    """Approval probability used for the training label, clamped to [0.1, 0.98]."""
    coding, years = "coding_accuracy_score", "coder_experience_years"
    payor = inputs.text("primary_payor")
    return Scorecard(
        base=0.8,
        rules=(
            Rule("coding_high", inputs.above(coding, 0.95), 0.1),
            Rule("coding_low", inputs.below(coding, 0.85), -0.15),
            Rule("coder_senior", inputs.above(years, 10), 0.05),
            Rule("coder_junior", inputs.below(years, 3), -0.1),
            Rule("authorization", inputs.flag("prior_authorization_obtained", False), 0.08),
            Rule("eligibility", inputs.flag("eligibility_verification_completed", False), 0.05),
            Rule("qa", inputs.flag("qa_review_completed", False), 0.03),
            Rule("enhanced", inputs.above("documentation_enhancement_score", 0.6), 0.05),
            Rule("network", inputs.text("network_status") == OUT_OF_NETWORK, -0.2),
            Rule("completeness", inputs.below("provider_data_completeness", 0.7), -0.15),
            Rule("late", inputs.above("days_service_to_submission", 60), -0.1),
            Rule("high_dollar", inputs.above("billed_amount", HIGH_DOLLAR), -0.05),
            Rule("missing", inputs.above("missing_documentation_count", 3), -0.12),
            Rule("history", inputs.above("patient_previous_rejections", 2), -0.08),
            Rule("medicaid", payor == "Medicaid", -0.05),
            Rule("medicare", payor == "Medicare", -0.03),
        ),
        low=0.1,
        high=0.98,
    )


def with_base_columns(claims: DataFrame) -> DataFrame:
    """Submission time, its weekday and flags, amount per age, and the risk indicators."""
    timed = claims.withColumn("submission_date", submission_time("days_service_to_submission"))
    submitted = F.col("submission_date")
    per_age = F.try_divide(F.col("billed_amount"), F.col("patient_age").cast("double"))
    return timed.withColumns(
        {
            "submission_day_of_week": F.weekday(submitted),
            "weekend_submission": weekend(submitted),
            "after_hours_submission": after_hours(F.hour(submitted), 17),
            "amount_per_age": half_up(per_age, 2),
            "high_dollar_claim": F.col("billed_amount") > HIGH_DOLLAR,
            "complex_diagnosis": F.col("primary_diagnosis_code").isin(COMPLEX_DIAGNOSES),
        }
    )


def with_approval_label(claims: DataFrame, draw: str = "u_label") -> DataFrame:
    """Unrounded ``probability``, its four-place form, and the label."""
    scored = claims.withColumn("probability", approval_card(Inputs(claims)).score())
    return scored.withColumns(
        {
            "approval_probability_actual": half_up(F.col("probability"), 4),
            "is_approved": F.col(draw) < F.col("probability"),
        }
    )


def _reasons() -> list[str]:
    return [reason for reasons in REASON_WEIGHTS.values() for reason in reasons]


def _adjustments(inputs: Inputs) -> list[tuple[Column, dict[str, float]]]:
    """Conditions and the weight multipliers each one applies."""
    # Multipliers by reason.
    return [
        (inputs.text("network_status") == OUT_OF_NETWORK, {"out_of_network_provider": 5}),
        (
            ~inputs.flag("prior_authorization_obtained", False),
            {"missing_prior_authorization": 3},
        ),
        (
            ~inputs.flag("eligibility_verification_completed", False),
            {"eligibility_verification_failed": 4},
        ),
        (
            inputs.below("provider_data_completeness", 0.7),
            {"insufficient_documentation": 2},
        ),
        (
            inputs.below("coding_accuracy_score", 0.9),
            {"incorrect_procedure_code": 2, "incorrect_diagnosis_code": 2},
        ),
        (
            inputs.above("days_service_to_submission", 60),
            {"timely_filing_limit_exceeded": 3},
        ),
    ]


def _weight_table(adjustments: list[tuple[Column, dict[str, float]]]) -> list[list[float]]:
    """The weights of all reasons for every combination of conditions.

    Row ``n`` holds the weights when the conditions at the set bits of ``n`` are true.
    """
    base = {r: w for reasons in REASON_WEIGHTS.values() for r, w in reasons.items()}
    table = []
    for combination in range(2 ** len(adjustments)):
        weights = dict(base)
        for bit, (_, multipliers) in enumerate(adjustments):
            if combination >> bit & 1:
                for reason, times in multipliers.items():
                    weights[reason] *= times
        table.append([weights[r] for r in _reasons()])
    return table


def _constant_table(rows: list[list[float]]) -> Column:
    """Array of arrays of doubles as one constant expression."""
    inner = ", ".join(f"array({', '.join(f'{v!r}D' for v in row)})" for row in rows)
    return F.expr(f"array({inner})")


def _combination(adjustments: list[tuple[Column, dict[str, float]]]) -> Column:
    bits = [
        F.when(test, F.lit(2**bit)).otherwise(F.lit(0)) for bit, (test, _) in enumerate(adjustments)
    ]
    return reduce(lambda a, b: a + b, bits)


def reason_weight_rows(claims: DataFrame, keys: list[str]) -> DataFrame:
    """Long form: one row per claim and reason with its position and weight."""
    adjustments = _adjustments(Inputs(claims))
    weights = F.get(_constant_table(_weight_table(adjustments)), _combination(adjustments))
    return claims.select(*keys, F.posexplode(weights).alias("position", "weight")).withColumn(
        "reason", F.get(F.lit(_reasons()), F.col("position"))
    )


def with_reason(claims: DataFrame, draw: str = "u_reason") -> DataFrame:
    """Weighted pick of a reason for each rejected claim; ``draw`` is uniform in [0, 1).

    The first reason whose running weight exceeds ``draw`` x total. The running weights of
    each combination of conditions are one constant array.
    """
    adjustments = _adjustments(Inputs(claims))
    running = [list(accumulate(weights)) for weights in _weight_table(adjustments)]
    reasons = _reasons()
    last = len(reasons) - 1
    staged = claims.withColumn("_upto", F.get(_constant_table(running), _combination(adjustments)))
    staged = staged.withColumn("_target", F.col(draw) * F.get(F.col("_upto"), F.lit(last)))
    # The target's place among the running weights, sorted downward, counts those above it.
    # This keeps the expression short where a filter on the reason is pushed into a join.
    place = F.array_position(
        F.sort_array(F.array_append(F.col("_upto"), F.col("_target")), asc=False), F.col("_target")
    )
    passed = F.least(F.lit(len(reasons) + 1) - place, F.lit(last)).cast("int")
    rejected = ~F.col("is_approved") & F.col(draw).isNotNull()
    return staged.withColumn(
        "rejection_reason", F.when(rejected, F.get(F.lit(reasons), passed))
    ).drop("_upto", "_target")


def reason_category(reason: Column, approved: Column) -> Column:
    """Category of a reason by constant map; ``other`` for an unknown one."""
    pairs = [
        F.lit(text)
        for category, reasons in REASON_WEIGHTS.items()
        for name in reasons
        for text in (name, category)
    ]
    known = F.try_element_at(F.create_map(*pairs), reason)
    return F.when(approved, F.lit("approved")).otherwise(F.coalesce(known, F.lit("other")))


def with_category(claims: DataFrame) -> DataFrame:
    return claims.withColumn(
        "rejection_category", reason_category(F.col("rejection_reason"), F.col("is_approved"))
    )


def payment_amount(expected: Column, billed: Column, variance: Column) -> Column:
    """Expected x variance, at most the billed amount; null if any input is null."""
    payment = expected * variance
    capped = F.when(payment.isNotNull() & billed.isNotNull(), F.least(payment, billed))
    return half_up(capped, 2)


def with_outcomes(claims: DataFrame, variance: Column | None = None) -> DataFrame:
    """Manual-review flag, payment by label, and no appeal for approved claims."""
    variance = F.lit(1.0) if variance is None else variance
    paid = payment_amount(F.col("expected_reimbursement"), F.col("billed_amount"), variance)
    return claims.withColumns(
        {
            "manual_review_flagged": F.col("probability") < 0.7,
            "final_payment_amount": F.when(F.col("is_approved"), paid).otherwise(F.lit(0.0)),
            "appeal_possible": ~F.col("is_approved"),
        }
    )


def labelled_training(claims: DataFrame) -> DataFrame:
    """Base columns, label, reason and category in one narrow projection."""
    return with_category(with_reason(with_approval_label(with_base_columns(claims))))


def with_derived_features(claims: DataFrame, as_of: datetime) -> DataFrame:
    """Time, ratio and composite features; ``days_since_service`` counts full days to ``as_of``."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("service_date").cast("timestamp_ntz"), moment)

    def number(name: str) -> Column:
        return F.col(name).cast("double")

    def flag(name: str) -> Column:
        return F.col(name).cast("int").cast("double")

    missing = number("missing_documentation_count") / 8.0
    return claims.withColumns(
        {
            "days_since_service": F.floor(seconds / 86400.0),
            "submission_month": F.month("submission_date"),
            "is_weekend_service": weekend(F.col("service_date")),
            "reimbursement_ratio": F.try_divide(
                F.col("expected_reimbursement"), F.col("billed_amount")
            ),
            "cost_per_processing_hour": F.try_divide(
                F.col("billed_amount"), number("processing_time_hours")
            ),
            "bpo_quality_score": F.col("coding_accuracy_score") * 0.3
            + F.col("documentation_enhancement_score") * 0.2
            + number("coder_experience_years") / 20.0 * 0.2
            + flag("prior_authorization_obtained") * 0.15
            + flag("eligibility_verification_completed") * 0.15,
            "provider_risk_score": (F.lit(1.0) - F.col("provider_data_completeness")) * 0.4
            + missing * 0.3
            + number("provider_response_time_hours") / 72.0 * 0.3,
            "claim_complexity_score": flag("high_dollar_claim") * 0.3
            + flag("complex_diagnosis") * 0.2
            + missing * 0.3
            + number("patient_previous_rejections") / 5.0 * 0.2,
        }
    )
