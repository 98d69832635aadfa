"""Medical claims: risk, labels, statistics, screening and pay-rate reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.functions import Inputs, half_up
from claimwright.operators import labels, reports, screening
from claimwright.operators import statistics as stats
from claimwright.plans import tables as t
from claimwright.session import settle
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"


def labelled(spark: SparkSession, sf_dir: str, state: bool = False) -> DataFrame:
    return labels.labelled_claims(derived.medical_claims(spark, sf_dir, state))


def with_baselines(spark, sf_dir) -> DataFrame:
    return stats.with_baselines(labelled(spark, sf_dir))


def screened(spark, sf_dir) -> DataFrame:
    return screening.screen(with_baselines(spark, sf_dir))


def risk_score(spark, sf_dir):
    claims = labels.with_risk(derived.medical_claims(spark, sf_dir))
    return claims.select(*ROW_KEYS, "risk", "risk_score")


def rejection_label(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        *ROW_KEYS, "rejection_probability", "is_rejected", "rejection_reason"
    )


def timing_flags(spark, sf_dir):
    return labels.with_timing(derived.medical_claims(spark, sf_dir)).select(
        *ROW_KEYS,
        "submission_date",
        F.col("days_between").cast("long").alias("days_between"),
        "is_weekend_submission",
        "is_after_hours_submission",
    )


def claim_ratios(spark, sf_dir):
    return labels.with_ratios(derived.medical_claims(spark, sf_dir)).select(
        *ROW_KEYS, "amount_per_age", "patient_rejection_rate"
    )


def billed_zscore(spark, sf_dir):
    claims = labelled(spark, sf_dir)
    scored = stats.with_zscore(claims, settle(stats.claim_baselines(claims), "baselines"))
    return scored.select(
        *ROW_KEYS, half_up(F.col("billed_amount_zscore"), 6).alias("billed_amount_zscore")
    )


def specialty_risk(spark, sf_dir):
    return with_baselines(spark, sf_dir).select(
        *ROW_KEYS, "provider_specialty", "provider_specialty_risk"
    )


def screening_components(spark, sf_dir):
    claims = with_baselines(spark, sf_dir)
    inputs = Inputs(claims)
    return claims.select(
        *ROW_KEYS,
        screening.coding_accuracy(inputs).alias("coding_accuracy"),
        screening.medical_necessity(inputs).alias("medical_necessity"),
        screening.unusual_amount(inputs).alias("unusual_amount"),
        screening.delayed(inputs).alias("delayed"),
    )


def screening_scores(spark, sf_dir):
    return screened(spark, sf_dir).select(
        *ROW_KEYS,
        "screening_approval_probability",
        "screening_submit_recommendation",
        "estimated_reimbursement",
        "processing_priority",
    )


def screening_factors(spark, sf_dir):
    return screened(spark, sf_dir).select(
        *ROW_KEYS, "screening_risk_factors", "screening_recommendations"
    )


def pay_rate_summary(spark, sf_dir):
    return reports.pay_rate_summary(screened(spark, sf_dir))


def priority_breakdown(spark, sf_dir):
    return reports.value_counts(screened(spark, sf_dir), "processing_priority")


def top_risk_factors(spark, sf_dir):
    slots = screening.risk_factor_slots(with_baselines(spark, sf_dir))
    return reports.top_slots(slots, "factor", with_share=True)


def top_risk_factors_plain(spark, sf_dir):
    slots = screening.risk_factor_slots(with_baselines(spark, sf_dir), with_detail=False)
    return reports.top_slots(slots, "factor", with_share=True)


def top_recommendations(spark, sf_dir):
    slots = screening.recommendation_slots(with_baselines(spark, sf_dir))
    return reports.top_slots(slots, "recommendation")


def claims_statistics(spark, sf_dir):
    return reports.claims_statistics(labelled(spark, sf_dir))


def rejection_analysis(spark, sf_dir):
    return reports.rejection_analysis(labelled(spark, sf_dir))


def specialty_analysis(spark, sf_dir):
    return reports.specialty_analysis(labelled(spark, sf_dir))


def _factor_sql(labels_sql: list[str]) -> str:
    return t.over(
        "mcs",
        f"SELECT entry AS factor, count(*) AS claims, "
        f"{t.half_up('count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM mcs) * 100e0', 1)} "
        f"AS percentage FROM ({t.exploded(labels_sql)}) GROUP BY entry "
        "ORDER BY claims DESC, factor LIMIT 10",
    )


def _mean(column: str, places: int) -> str:
    return f"coalesce({t.half_up(t.exact_mean(column), places)}, 0e0)"


_RATE = t.half_up(
    "CAST(rejected_claims AS DOUBLE) / nullif(CAST(total_claims AS DOUBLE), 0e0) * 100e0", 2
)

QUERIES = {
    "risk_score": (risk_score, t.over("mc", f"SELECT {_KEYS}, risk, risk_score FROM mc")),
    "rejection_label": (
        rejection_label,
        t.over(
            "mc",
            f"SELECT {_KEYS}, rejection_probability, is_rejected, rejection_reason FROM mc",
        ),
    ),
    "timing_flags": (
        timing_flags,
        t.over(
            "mc1",
            f"SELECT {_KEYS}, submission_date, "
            "date_diff('day', service_date, submission_date) AS days_between, "
            "isodow(submission_date) - 1 >= 5 AS is_weekend_submission, "
            "hour(submission_date) < 8 OR hour(submission_date) > 18 "
            "AS is_after_hours_submission FROM mc1",
        ),
    ),
    "claim_ratios": (
        claim_ratios,
        t.over("mc1", f"SELECT {_KEYS}, amount_per_age, patient_rejection_rate FROM mc1"),
    ),
    "billed_zscore": (
        billed_zscore,
        t.over(
            "mcz",
            f"SELECT {_KEYS}, {t.half_up('billed_amount_zscore', 6)} AS billed_amount_zscore "
            "FROM mcz",
        ),
    ),
    "specialty_risk": (
        specialty_risk,
        t.over("mcz", f"SELECT {_KEYS}, provider_specialty, provider_specialty_risk FROM mcz"),
    ),
    "screening_components": (
        screening_components,
        t.over(
            "mcs",
            f"SELECT {_KEYS}, coding_accuracy, medical_necessity, "
            "abs(billed_amount_zscore) > 2 OR billed_amount > 20000 AS unusual_amount, "
            "days_to_submission > 60 AS delayed FROM mcs",
        ),
    ),
    "screening_scores": (
        screening_scores,
        t.over(
            "mcs",
            f"SELECT {_KEYS}, screening_approval_probability, screening_submit_recommendation, "
            "estimated_reimbursement, processing_priority FROM mcs",
        ),
    ),
    "screening_factors": (
        screening_factors,
        t.over(
            "mcs",
            f"SELECT {_KEYS}, {t.joined(t.SCREENING_LABELS)} AS screening_risk_factors, "
            f"{t.joined(t.SCREENING_ACTIONS)} AS screening_recommendations FROM mcs",
        ),
    ),
    "pay_rate_summary": (
        pay_rate_summary,
        t.over(
            "mcs",
            "SELECT n AS total_claims_screened, a AS approved_for_submission, "
            "n - a AS held_for_review, "
            f"{t.half_up('CAST(a AS DOUBLE) / n', 3)} AS submission_rate, "
            "billed AS total_billed_amount, expected AS expected_reimbursement, "
            f"{t.half_up('expected / billed', 3)} AS expected_pay_rate FROM "
            f"(SELECT count(*) AS n, {t.count_if('screening_submit_recommendation')} AS a, "
            f"{t.exact_sum('billed_amount')} AS billed, "
            f"{t.exact_sum('estimated_reimbursement')} AS expected FROM mcs)",
        ),
    ),
    "priority_breakdown": (
        priority_breakdown,
        t.over(
            "mcs",
            "SELECT processing_priority, count(*) AS claims FROM mcs GROUP BY 1 "
            "ORDER BY claims DESC, processing_priority",
        ),
    ),
    "top_risk_factors": (top_risk_factors, _factor_sql(t.SCREENING_LABELS)),
    "top_risk_factors_plain": (
        top_risk_factors_plain,
        _factor_sql(
            [
                "'Poor documentation quality'" if "documentation" in x else
                "'Patient has high rejection history'" if "history" in x else x
                for x in t.SCREENING_LABELS
            ]
        ),
    ),
    "top_recommendations": (
        top_recommendations,
        t.over(
            "mcs",
            "SELECT entry AS recommendation, count(*) AS claims FROM "
            f"({t.exploded(t.SCREENING_ACTIONS)}) GROUP BY entry "
            "ORDER BY claims DESC, recommendation LIMIT 10",
        ),
    ),
    "claims_statistics": (
        claims_statistics,
        t.over(
            "mc",
            f"SELECT total_claims, rejected_claims, {_RATE} AS rejection_rate_percent, "
            f"coalesce({t.half_up('age', 1)}, 0e0) AS avg_patient_age, "
            "avg_billed_amount, avg_risk_score, earliest_service, latest_service, "
            "unique_patients, unique_providers FROM (SELECT count(*) AS total_claims, "
            f"{t.count_if('is_rejected')} AS rejected_claims, "
            "avg(CAST(patient_age AS DOUBLE)) AS age, "
            f"{_mean('billed_amount', 2)} AS avg_billed_amount, "
            f"{_mean('risk_score', 3)} AS avg_risk_score, "
            "min(service_date) AS earliest_service, max(service_date) AS latest_service, "
            "count(DISTINCT patient_id) AS unique_patients, "
            "count(DISTINCT provider_id) AS unique_providers FROM mc)",
        ),
    ),
    "rejection_analysis": (
        rejection_analysis,
        t.over(
            "mc",
            "SELECT rejection_reason AS reason, count(*) AS claims, "
            f"{_mean('billed_amount', 2)} AS avg_amount FROM mc "
            "WHERE is_rejected AND rejection_reason IS NOT NULL GROUP BY 1 "
            "ORDER BY claims DESC, reason",
        ),
    ),
    "specialty_analysis": (
        specialty_analysis,
        t.over(
            "mc",
            f"SELECT specialty, total_claims, rejected_claims, avg_amount, {_RATE} "
            "AS rejection_rate FROM (SELECT provider_specialty AS specialty, "
            f"count(*) AS total_claims, {t.count_if('is_rejected')} AS rejected_claims, "
            f"{_mean('billed_amount', 2)} AS avg_amount FROM mc GROUP BY 1) "
            "ORDER BY total_claims DESC, specialty",
        ),
    ),
}
