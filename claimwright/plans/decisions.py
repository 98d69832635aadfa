"""Training claims: labels, production decisions, derived features and their reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from claimwright.functions import Inputs
from claimwright.operators import decisions, reports, training
from claimwright.plans import tables as t
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"
AS_OF = datetime(2002, 1, 1)


def base(spark, sf_dir, state=False):
    return training.with_base_columns(derived.claims_training(spark, sf_dir, state))


def labelled(spark, sf_dir, state=False):
    return training.labelled_training(derived.claims_training(spark, sf_dir, state))


def _decided(spark, sf_dir):
    return decisions.decide(derived.claims_training(spark, sf_dir))


def _facts(spark, sf_dir):
    return decisions.decision_facts(derived.claims_training(spark, sf_dir))


def _recommendation_columns():
    r = F.col("recommendation")
    return [
        r.getField("action").alias("action"),
        r.getField("priority").alias("priority"),
        F.array_join(r.getField("recommendations"), "; ").alias("recommendations"),
        r.getField("expected_reimbursement").alias("expected_reimbursement"),
    ]


_PREDICTION = [
    *ROW_KEYS,
    "claim_id",
    "approval_probability",
    "predicted_approved",
    "confidence_score",
    "decision_margin",
]


def approval_decisions(spark, sf_dir):
    return _decided(spark, sf_dir).select(*_PREDICTION, *_recommendation_columns())


def rejection_reason_rules(spark, sf_dir):
    return _decided(spark, sf_dir).select(*ROW_KEYS, "rejection_reason")


def rejection_reason_counts(spark, sf_dir):
    return reports.value_counts(_decided(spark, sf_dir), "rejection_reason")


def fallback_decisions(spark, sf_dir):
    """Decisions where some rows have a null service flag or text in a numeric column."""
    claims = derived.claims_training(spark, sf_dir).withColumns(
        {
            "prior_authorization_obtained": F.expr(
                "CASE WHEN (ok + ln) % 50 <> 0 THEN prior_authorization_obtained END"
            ),
            "coding_accuracy_score": F.expr(
                "CASE WHEN (ok + pk) % 41 = 0 THEN 'n/a' WHEN (ok + pk) % 43 <> 0 "
                "THEN CAST(coding_accuracy_score AS STRING) END"
            ),
        }
    )
    return decisions.decide(claims).select(
        *_PREDICTION, "rejection_reason", *_recommendation_columns()
    )


def model_inputs(spark, sf_dir):
    claims = decisions.model_inputs(derived.claims_training(spark, sf_dir))
    return claims.select(*ROW_KEYS, *[c for c in claims.columns if c.startswith("x_")])


def batch_summary(spark, sf_dir):
    return reports.batch_summary(_facts(spark, sf_dir))


def dashboard_metrics(spark, sf_dir):
    return reports.dashboard_metrics(_facts(spark, sf_dir))


def approval_probability(spark, sf_dir):
    claims = training.with_approval_label(base(spark, sf_dir))
    return claims.select(
        *ROW_KEYS, "probability", "approval_probability_actual", "is_approved"
    )


def risk_indicators(spark, sf_dir):
    return base(spark, sf_dir).select(
        *ROW_KEYS,
        "submission_day_of_week",
        "weekend_submission",
        "after_hours_submission",
        "high_dollar_claim",
        "complex_diagnosis",
    )


def reason_weights(spark, sf_dir):
    return training.reason_weight_rows(derived.claims_training(spark, sf_dir), ROW_KEYS)


def reason_weight_totals(spark, sf_dir):
    """Mean weight of each reason over all claims."""
    rows = training.reason_weight_rows(derived.claims_training(spark, sf_dir), ROW_KEYS)
    return rows.groupBy("reason").agg(reports.exact_mean(F.col("weight")).alias("mean_weight"))


def reason_pick(spark, sf_dir):
    return labelled(spark, sf_dir).select(*ROW_KEYS, "is_approved", "rejection_reason")


def rejection_categories(spark, sf_dir):
    return labelled(spark, sf_dir).select(*ROW_KEYS, "rejection_category")


def training_outcomes(spark, sf_dir):
    claims = training.with_outcomes(training.with_approval_label(base(spark, sf_dir)))
    return claims.select(
        *ROW_KEYS, "manual_review_flagged", "final_payment_amount", "appeal_possible"
    )


_DERIVED = [
    "days_since_service",
    "submission_month",
    "is_weekend_service",
    "reimbursement_ratio",
    "cost_per_processing_hour",
    "bpo_quality_score",
    "provider_risk_score",
    "claim_complexity_score",
]


def derived_features(spark, sf_dir):
    return training.with_derived_features(base(spark, sf_dir), AS_OF).select(*ROW_KEYS, *_DERIVED)


def training_summary(spark, sf_dir):
    return reports.training_summary(training.with_approval_label(base(spark, sf_dir)))


def rejected_claims(spark, sf_dir):
    """Row filter by a negated label."""
    return labelled(spark, sf_dir).filter(~F.col("is_approved")).select(
        *ROW_KEYS, "billed_amount", "rejection_reason", "rejection_category"
    )


def top_rejection_reasons(spark, sf_dir):
    rejected = ~F.col("is_approved")
    return reports.shares_of(labelled(spark, sf_dir), "rejection_reason", 5, among=rejected)


def category_shares(spark, sf_dir):
    return reports.shares_of(labelled(spark, sf_dir), "rejection_category")


def label_rates(spark, sf_dir):
    return reports.label_rates(
        labelled(spark, sf_dir, state=True),
        "is_approved",
        ["patient_state", "primary_payor", "rejection_reason", "bpo_coder"],
    )


def revenue_impact(spark, sf_dir):
    """Projection from the accuracy of the rule-based decisions against the label."""
    claims = training.with_approval_label(base(spark, sf_dir))
    inputs = Inputs(claims)
    right = (decisions.approval_card(inputs).score() > 0.5) == F.col("is_approved")
    accuracy = claims.agg(reports.mean_of_flag(right).alias("accuracy"))
    return reports.revenue_impact(accuracy)


_RECOMMENDATIONS = (
    "concat_ws('; ', CASE WHEN coding_accuracy_score < 0.9e0 THEN 'Review coding with senior coder' "
    "END, CASE WHEN provider_data_completeness < 0.8e0 THEN "
    "'Request additional documentation from provider' END, "
    "CASE WHEN NOT prior_authorization_obtained THEN "
    "'Obtain prior authorization before submission' END, "
    "CASE WHEN network_status = 'Out-of-Network' THEN 'Verify out-of-network benefits' END)"
)
_REASON = (
    "CASE WHEN NOT predicted_approved THEN CASE WHEN NOT prior_authorization_obtained "
    "THEN 'missing_prior_authorization' WHEN NOT eligibility_verification_completed "
    "THEN 'eligibility_verification_failed' WHEN provider_data_completeness < 0.7e0 "
    "THEN 'insufficient_documentation' WHEN coding_accuracy_score < 0.85e0 "
    "THEN 'incorrect_coding' WHEN network_status = 'Out-of-Network' "
    "THEN 'out_of_network_provider' WHEN days_service_to_submission > 90 "
    "THEN 'timely_filing_limit_exceeded' ELSE 'medical_necessity_not_established' END END"
)
_SCORED = (
    f"{t.half_up('p', 3)} AS approval_probability, predicted_approved, "
    f"{t.half_up('least(p, 1e0 - p) + 0.5e0', 3)} AS confidence_score, "
    "abs(p - 0.5e0) AS decision_margin"
)
_CODING_GAP = "(ok + pk) % 41 <> 0 AND (ok + pk) % 43 = 0"
_FALLBACK = "((ok + ln) % 50 = 0 OR (ok + pk) % 41 = 0)"


def _fallback_sql() -> str:
    """Claims with gaps: fallback rows get constants, a null score fires no rule."""
    gap = f"CASE WHEN {_CODING_GAP} THEN NULL ELSE coding_accuracy_score END"
    core = t.over("cd", "")
    return (
        core.replace("ct0 AS (", "ct00 AS (", 1).replace(
            "ct1 AS (",
            f"ct0 AS (SELECT * REPLACE ({gap} AS coding_accuracy_score) FROM ct00), ct1 AS (",
            1,
        )
        + f"SELECT {_KEYS}, claim_id, "
        f"CASE WHEN {_FALLBACK} THEN 0.75e0 ELSE {t.half_up('p', 3)} END AS approval_probability, "
        f"({_FALLBACK} OR predicted_approved) AS predicted_approved, "
        f"CASE WHEN {_FALLBACK} THEN 0.6e0 ELSE "
        f"{t.half_up('least(p, 1e0 - p) + 0.5e0', 3)} END AS confidence_score, "
        f"CASE WHEN NOT {_FALLBACK} THEN abs(p - 0.5e0) END AS decision_margin, "
        f"CASE WHEN NOT {_FALLBACK} THEN {_REASON} END AS rejection_reason, "
        f"CASE WHEN {_FALLBACK} THEN 'QA_REVIEW' ELSE action END AS action, "
        f"CASE WHEN {_FALLBACK} THEN 'MEDIUM' ELSE priority END AS priority, "
        f"CASE WHEN {_FALLBACK} THEN 'Manual review required - model unavailable' "
        f"ELSE {_RECOMMENDATIONS} END AS recommendations, "
        f"CASE WHEN {_FALLBACK} THEN billed_amount * 0.75e0 "
        "ELSE expected_reimbursement_by_rule END AS expected_reimbursement FROM cd"
    )


_SUMMARY = (
    "SELECT count(*) AS total_claims, "
    f"{t.count_if(chr(39).join(['action = ', 'SUBMIT', '']))} AS submit_count, "
    f"{t.count_if(chr(39).join(['action = ', 'QA_REVIEW', '']))} AS qa_review_count, "
    f"{t.count_if(chr(39).join(['action = ', 'HOLD', '']))} AS hold_count, "
    f"{t.exact_sum('billed_amount')} AS total_billed, "
    f"{t.exact_sum('expected_reimbursement_by_rule')} AS expected_reimbursement FROM cd"
)
_SUBMISSION_RATE = t.half_up("CAST(submit_count AS DOUBLE) / total_claims", 3)
_PAY_RATE = t.half_up("expected_reimbursement / total_billed", 3)


def _metric(name: str, value: str) -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM s"


_COMPOSITES = (
    "coding_accuracy_score * 0.3e0 + documentation_enhancement_score * 0.2e0 "
    "+ (coder_experience_years / 20e0) * 0.2e0 "
    "+ CAST(prior_authorization_obtained AS INT) * 0.15e0 "
    "+ CAST(eligibility_verification_completed AS INT) * 0.15e0 AS bpo_quality_score, "
    "(1e0 - provider_data_completeness) * 0.4e0 + (missing_documentation_count / 8e0) * 0.3e0 "
    "+ (provider_response_time_hours / 72e0) * 0.3e0 AS provider_risk_score, "
    "CAST(high_dollar_claim AS INT) * 0.3e0 + CAST(complex_diagnosis AS INT) * 0.2e0 "
    "+ (missing_documentation_count / 8e0) * 0.3e0 "
    "+ (patient_previous_rejections / 5e0) * 0.2e0 AS claim_complexity_score"
)

QUERIES = {
    "approval_decisions": (
        approval_decisions,
        t.over(
            "cd",
            f"SELECT {_KEYS}, claim_id, {_SCORED}, action, priority, "
            f"{_RECOMMENDATIONS} AS recommendations, "
            "expected_reimbursement_by_rule AS expected_reimbursement FROM cd",
        ),
    ),
    "rejection_reason_rules": (
        rejection_reason_rules,
        t.over("cd", f"SELECT {_KEYS}, {_REASON} AS rejection_reason FROM cd"),
    ),
    "rejection_reason_counts": (
        rejection_reason_counts,
        t.over(
            "cd",
            f"SELECT rejection_reason, count(*) AS claims FROM (SELECT {_REASON} "
            "AS rejection_reason FROM cd) WHERE rejection_reason IS NOT NULL GROUP BY 1",
        ),
    ),
    "fallback_decisions": (fallback_decisions, _fallback_sql()),
    "model_inputs": (
        model_inputs,
        t.over(
            "ct0",
            f"SELECT {_KEYS}, CAST(patient_age AS DOUBLE) AS x_patient_age, "
            "billed_amount AS x_billed_amount, coding_accuracy_score AS x_coding_accuracy_score, "
            "provider_data_completeness AS x_provider_data_completeness, "
            "CAST(coder_experience_years AS DOUBLE) AS x_coder_experience_years, "
            "CAST(days_service_to_submission AS DOUBLE) AS x_days_service_to_submission, "
            "CAST(prior_authorization_obtained AS DOUBLE) AS x_prior_authorization, "
            "CAST(eligibility_verification_completed AS DOUBLE) AS x_eligibility_verified, "
            "CASE WHEN network_status = 'In-Network' THEN 1e0 ELSE 0e0 END AS x_in_network, "
            "documentation_enhancement_score AS x_documentation_enhancement_score FROM ct0",
        ),
    ),
    "batch_summary": (
        batch_summary,
        t.over(
            "cd",
            f"SELECT *, {_SUBMISSION_RATE} AS submission_rate, {_PAY_RATE} AS expected_pay_rate "
            f"FROM ({_SUMMARY})",
        ),
    ),
    "dashboard_metrics": (
        dashboard_metrics,
        t.over("cd", "")
        + f", s AS ({_SUMMARY}) "
        + " UNION ALL ".join(
            [
                _metric("total_claims", "total_claims"),
                _metric("submit_count", "submit_count"),
                _metric("qa_review_count", "qa_review_count"),
                _metric("hold_count", "hold_count"),
                _metric("submission_rate", _SUBMISSION_RATE),
                _metric("total_billed", "total_billed"),
                _metric("expected_reimbursement", "expected_reimbursement"),
                _metric("expected_pay_rate", _PAY_RATE),
                _metric(
                    "quality_gate",
                    "CAST(submit_count + qa_review_count AS DOUBLE) / total_claims",
                ),
                _metric("claims_per_hour", "total_claims / 8e0"),
            ]
        ),
    ),
    "approval_probability": (
        approval_probability,
        t.over(
            "ct",
            f"SELECT {_KEYS}, probability, approval_probability_actual, is_approved FROM ct",
        ),
    ),
    "risk_indicators": (
        risk_indicators,
        t.over(
            "ct",
            f"SELECT {_KEYS}, submission_day_of_week, weekend_submission, "
            "after_hours_submission, high_dollar_claim, complex_diagnosis FROM ct",
        ),
    ),
    "reason_weights": (reason_weights, t.over("ct", t.reason_weight_rows())),
    "reason_weight_totals": (
        reason_weight_totals,
        t.over(
            "ct",
            f"SELECT reason, {t.exact_mean('weight')} AS mean_weight "
            f"FROM ({t.reason_weight_rows()}) GROUP BY 1",
        ),
    ),
    "reason_pick": (
        reason_pick,
        t.over("ct_pick", f"SELECT {_KEYS}, is_approved, rejection_reason FROM ct_pick"),
    ),
    "rejection_categories": (
        rejection_categories,
        t.over("ct_cat", f"SELECT {_KEYS}, rejection_category FROM ct_cat"),
    ),
    "training_outcomes": (
        training_outcomes,
        t.over(
            "ct",
            f"SELECT {_KEYS}, probability < 0.7e0 AS manual_review_flagged, "
            "CASE WHEN is_approved THEN "
            f"{t.half_up('least(expected_reimbursement * 1e0, billed_amount)', 2)} ELSE 0e0 END "
            "AS final_payment_amount, NOT is_approved AS appeal_possible FROM ct",
        ),
    ),
    "derived_features": (
        derived_features,
        t.over(
            "ct",
            f"SELECT {_KEYS}, date_diff('second', service_date, TIMESTAMP '2002-01-01') // 86400 "
            "AS days_since_service, month(submission_date) AS submission_month, "
            "isodow(service_date) - 1 >= 5 AS is_weekend_service, "
            "expected_reimbursement / nullif(billed_amount, 0e0) AS reimbursement_ratio, "
            "billed_amount / nullif(CAST(processing_time_hours AS DOUBLE), 0e0) "
            f"AS cost_per_processing_hour, {_COMPOSITES} FROM ct",
        ),
    ),
    "training_summary": (
        training_summary,
        t.over(
            "ct",
            f"SELECT count(*) AS total_claims, {t.flag_mean('is_approved')} AS approval_rate, "
            f"{t.exact_mean('approval_probability_actual')} AS avg_approval_probability FROM ct",
        ),
    ),
    "rejected_claims": (
        rejected_claims,
        t.over(
            "ct_cat",
            f"SELECT {_KEYS}, billed_amount, rejection_reason, rejection_category "
            "FROM ct_cat WHERE NOT is_approved",
        ),
    ),
    "top_rejection_reasons": (
        top_rejection_reasons,
        t.over(
            "ct_cat",
            "SELECT rejection_reason, count(*) AS claims, count(*) / "
            "(SELECT CAST(count(*) AS DOUBLE) FROM ct_cat WHERE NOT is_approved) AS share "
            "FROM ct_cat WHERE NOT is_approved GROUP BY 1 "
            "ORDER BY claims DESC, rejection_reason LIMIT 5",
        ),
    ),
    "category_shares": (
        category_shares,
        t.over(
            "ct_cat",
            "SELECT rejection_category, count(*) AS claims, "
            "count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM ct_cat) AS share "
            "FROM ct_cat GROUP BY 1",
        ),
    ),
    "label_rates": (
        label_rates,
        t.over(
            "ct_cat",
            f"SELECT count(*) AS total, {t.flag_mean('is_approved')} AS is_approved_rate, "
            "count(DISTINCT patient_state) AS patient_state_values, "
            "count(DISTINCT primary_payor) AS primary_payor_values, "
            "count(DISTINCT rejection_reason) AS rejection_reason_values, "
            "count(DISTINCT bpo_coder) AS bpo_coder_values FROM ct_cat",
        ),
    ),
    "revenue_impact": (
        revenue_impact,
        t.over(
            "cd",
            "SELECT accuracy, 0.85e0 AS current_approval_rate, "
            "least(0.95e0, 0.85e0 + (accuracy - 0.5e0) * 0.2e0) AS projected_approval_rate, "
            "least(0.95e0, 0.85e0 + (accuracy - 0.5e0) * 0.2e0) - 0.85e0 AS improvement "
            f"FROM (SELECT {t.flag_mean('predicted_approved = is_approved')} AS accuracy FROM cd)",
        ),
    ),
}
