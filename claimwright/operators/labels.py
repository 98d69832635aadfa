"""Claim risk, rejection labels, timing and ratio columns of the medical claims table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule, Scorecard, half_up
from claimwright.sources.derived import MEDICAL_REJECTION_REASONS, submission_time

OUT_OF_NETWORK = "Out-of-Network"
IN_NETWORK = "In-Network"


def after_hours(hour: Column, last_hour: int) -> Column:
    """Before 8 or after ``last_hour``: 18 for medical claims, 17 for training claims."""
    return (hour < 8) | (hour > last_hour)


def weekend(moment: Column) -> Column:
    return F.weekday(moment) >= 5


def risk_card(inputs: Inputs) -> Scorecard:
    """Claim risk from 0 upward."""
    return Scorecard(
        base=0.0,
        rules=(
            Rule("network", inputs.text("provider_network_status") == OUT_OF_NETWORK, 0.3),
            Rule("late", inputs.above("days_to_submission", 30), 0.2),
            Rule("amount", inputs.above("billed_amount", 10000), 0.2),
            Rule("history", inputs.above("patient_previous_rejections", 2), 0.2),
            Rule("documents", inputs.below("documentation_quality_score", 0.6), 0.3),
            Rule("fraud_area", inputs.flag("high_fraud_area", False), 0.1),
            Rule("after_hours", after_hours(inputs.number("submission_hour"), 18), 0.1),
            Rule("volume", inputs.above("provider_monthly_claims", 150), 0.1),
        ),
    )


def with_timing(claims: DataFrame, days_column: str = "days_to_submission") -> DataFrame:
    """Submission time, whole days to submission, weekend and after-hours flags."""
    timed = claims.withColumn("submission_date", submission_time(days_column))
    hour = F.hour("submission_date")
    return timed.withColumns(
        {
            "days_between": F.datediff("submission_date", "service_date"),
            "is_weekend_submission": weekend(F.col("submission_date")),
            "is_after_hours_submission": after_hours(hour, 18),
        }
    )


def with_ratios(claims: DataFrame) -> DataFrame:
    """Billed amount per year of age, and rejections per earlier claim."""
    billed = F.col("billed_amount")
    per_age = F.try_divide(billed, F.col("patient_age").cast("double"))
    rate = F.col("patient_previous_rejections").cast("double") / F.greatest(
        F.lit(1), F.col("patient_previous_claims")
    )
    return claims.withColumns(
        {
            "amount_per_age": half_up(per_age, 2),
            "patient_rejection_rate": half_up(rate, 3),
        }
    )


def with_risk(claims: DataFrame) -> DataFrame:
    """Unrounded ``risk`` and ``risk_score`` at three places."""
    scored = claims.withColumn("risk", risk_card(Inputs(claims)).score())
    return scored.withColumn("risk_score", half_up(F.col("risk"), 3))


def with_rejection_label(claims: DataFrame, draw: str = "u_label") -> DataFrame:
    """Rejection probability, label and reason; ``draw`` is uniform in [0, 1)."""
    reason = F.get(F.lit(MEDICAL_REJECTION_REASONS), F.col("reason_draw"))
    labelled = claims.withColumn("rejection_probability", F.least("risk", F.lit(0.9)))
    labelled = labelled.withColumn("is_rejected", F.col(draw) < F.col("rejection_probability"))
    return labelled.withColumn(
        "rejection_reason", F.when(F.col("is_rejected"), reason)
    )


def labelled_claims(claims: DataFrame) -> DataFrame:
    """Ratios, risk and rejection label in one narrow projection."""
    return with_rejection_label(with_risk(with_ratios(claims)))
