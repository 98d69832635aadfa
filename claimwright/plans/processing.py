"""Processing claims: outcomes, performance reports and KPIs."""

from __future__ import annotations

from claimwright.operators import processing, reports
from claimwright.plans import tables as t
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"
_OUTCOMES = [
    "final_billed_amount",
    "qa_review_required",
    "qa_reviewer",
    "turnaround_sla_met",
    "bpo_success_probability",
    "claim_successful",
    "actual_reimbursement",
    "bpo_fee_earned",
    "net_collection_rate",
    "requires_appeal",
    "appeal_success_probability",
    "provider_feedback_required",
    "bpo_roi",
]


def processed(spark, sf_dir):
    return processing.processed(derived.claims_processing(spark, sf_dir))


def processing_outcomes(spark, sf_dir):
    return processed(spark, sf_dir).select(*ROW_KEYS, *_OUTCOMES)


def performance_overall(spark, sf_dir):
    return reports.performance_overall(processed(spark, sf_dir))


def performance_quality(spark, sf_dir):
    return reports.performance_quality(processed(spark, sf_dir))


def top_coders(spark, sf_dir):
    return reports.top_coders(processed(spark, sf_dir))


def coder_kpis(spark, sf_dir):
    return reports.coder_kpis(processed(spark, sf_dir))


def payor_specialty_kpis(spark, sf_dir):
    return reports.payor_specialty_kpis(processed(spark, sf_dir))


_BILLED = t.exact_sum("final_billed_amount")
_COLLECTED = t.exact_sum("actual_reimbursement")
_FEES = t.exact_sum("bpo_fee_earned")

QUERIES = {
    "processing_outcomes": (
        processing_outcomes,
        t.over("cp", f"SELECT {_KEYS}, {', '.join(_OUTCOMES)} FROM cp"),
    ),
    "performance_overall": (
        performance_overall,
        t.over(
            "cp",
            "SELECT n AS total_claims_processed, "
            f"{t.half_up('CAST(won AS DOUBLE) / n', 3)} AS success_rate, "
            f"{t.half_up('collected / billed', 3)} AS net_collection_rate, "
            f"{t.half_up('collected', 2)} AS total_revenue_collected, "
            f"{t.half_up('fees', 2)} AS total_bpo_fees_earned, "
            f"{t.half_up('hours', 2)} AS avg_processing_hours, "
            f"{t.half_up('sla', 3)} AS sla_compliance_rate FROM (SELECT count(*) AS n, "
            f"{t.count_if('claim_successful')} AS won, {_BILLED} AS billed, "
            f"{_COLLECTED} AS collected, {_FEES} AS fees, "
            "avg(CAST(bpo_processing_hours AS DOUBLE)) AS hours, "
            f"{t.flag_mean('turnaround_sla_met')} AS sla FROM cp)",
        ),
    ),
    "performance_quality": (
        performance_quality,
        t.over(
            "cp",
            f"SELECT {t.half_up(t.exact_mean('coding_accuracy_score'), 3)} AS avg_coding_accuracy, "
            f"{t.half_up(t.exact_mean('raw_data_completeness_score'), 3)} "
            "AS avg_raw_data_completeness, "
            f"{t.half_up(t.exact_mean('client_satisfaction_score'), 2)} "
            "AS avg_client_satisfaction, "
            f"{t.half_up(t.flag_mean('qa_review_required'), 3)} AS qa_review_rate FROM cp",
        ),
    ),
    "top_coders": (
        top_coders,
        t.over(
            "cp",
            f"SELECT assigned_coder, {t.flag_mean('claim_successful')} AS success_rate, "
            f"{_FEES} AS fees_earned, {t.exact_mean('coding_accuracy_score')} AS coding_accuracy "
            "FROM cp GROUP BY 1 ORDER BY success_rate DESC, assigned_coder LIMIT 5",
        ),
    ),
    "coder_kpis": (
        coder_kpis,
        t.over(
            "cp",
            "SELECT assigned_coder, count(*) AS claims, "
            "count(*) / CAST(sum(bpo_processing_hours) AS DOUBLE) AS claims_per_hour, "
            f"{_FEES} / CAST(sum(bpo_processing_hours) AS DOUBLE) AS fee_per_hour, "
            f"{_COLLECTED} / {_BILLED} AS pay_rate, "
            f"{t.exact_mean('client_satisfaction_score')} AS client_satisfaction, "
            f"{t.exact_mean('documentation_enhancement_score')} AS documentation_score "
            "FROM cp GROUP BY 1",
        ),
    ),
    "payor_specialty_kpis": (
        payor_specialty_kpis,
        t.over(
            "cp",
            "SELECT primary_payor, provider_specialty, "
            "CAST(grouping(primary_payor) * 2 + grouping(provider_specialty) AS BIGINT) AS level, "
            f"count(*) AS claims, {t.flag_mean('claim_successful')} AS success_rate, "
            f"{_BILLED} AS billed, {_COLLECTED} AS collected, "
            f"{_COLLECTED} / {_BILLED} AS pay_rate "
            "FROM cp GROUP BY CUBE (primary_payor, provider_specialty)",
        ),
    ),
}
