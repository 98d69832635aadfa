"""Outcomes of the processing claims table: success, money, appeals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule, Scorecard, half_up

HOURLY_COST = 25


def success_card(inputs: Inputs) -> Scorecard:
    """Processing success probability from 0.7, clamped to [0.1, 0.98]."""
    reviewed = inputs.flag("qa_review_required", False) & inputs.text("qa_reviewer").isNotNull()
    return Scorecard(
        base=0.7,
        rules=(
            Rule("coding", inputs.above("coding_accuracy_score", 0.95), 0.15),
            Rule("completeness", inputs.above("raw_data_completeness_score", 0.9), 0.1),
            Rule("authorization", inputs.flag("prior_authorization_obtained", False), 0.1),
            Rule("eligibility", inputs.flag("eligibility_verification_completed", False), 0.05),
            Rule("reviewed", reviewed, 0.05),
            Rule("enhanced", inputs.above("documentation_enhancement_score", 0.5), 0.05),
            Rule("missing", inputs.above("missing_elements_count", 3), -0.2),
            Rule("unclear", inputs.flag("required_provider_clarification", False), -0.15),
            Rule("tier", inputs.text("payor_relationship_tier") == "Tier_3", -0.1),
        ),
        low=0.1,
        high=0.98,
    )


def _guarded_max(low: float, value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), value))


def with_billing(claims: DataFrame) -> DataFrame:
    """Final billed amount (at least 50), the QA gate and the turnaround flag."""
    billed = claims.withColumns(
        {
            "final_billed_amount": _guarded_max(
                50.0, F.col("raw_provider_charges") + F.col("bpo_coding_adjustments")
            ),
            "turnaround_sla_met": F.col("bpo_processing_hours") <= 24,
        }
    )
    gated = billed.withColumn(
        "qa_review_required", (F.col("final_billed_amount") > 5000) & F.col("qa_flag_draw")
    )
    return gated.withColumn("qa_reviewer", F.when(F.col("qa_review_required"), F.col("assigned_coder")))


def with_outcomes(claims: DataFrame) -> DataFrame:
    """Success label, reimbursement, fees, appeal and return figures.

    ``u_label``, ``u_appeal`` (uniform in [0, 1)) and ``payment_rate`` are input columns.
    """
    scored = claims.withColumn("_p", success_card(Inputs(claims)).score())
    labelled = scored.withColumn("claim_successful", F.col("u_label") < F.col("_p"))
    won = F.col("claim_successful")
    paid = labelled.withColumns(
        {
            "_reimbursement": F.when(
                won, F.col("final_billed_amount") * F.col("payment_rate")
            ).otherwise(F.lit(0.0)),
            "requires_appeal": ~won & (F.col("u_appeal") < 0.6),
        }
    )
    flat = F.col("bpo_flat_fee").cast("double")
    feed = paid.withColumn(
        "_fee",
        F.when(won, F.col("_reimbursement") * F.col("bpo_fee_percentage") + flat).otherwise(flat),
    )
    billed, hours = F.col("final_billed_amount"), F.col("bpo_processing_hours")
    return feed.withColumns(
        {
            "bpo_success_probability": half_up(F.col("_p"), 3),
            "actual_reimbursement": half_up(F.col("_reimbursement"), 2),
            "bpo_fee_earned": half_up(F.col("_fee"), 2),
            "net_collection_rate": half_up(
                F.when(billed > 0, F.col("_reimbursement") / billed).otherwise(F.lit(0.0)), 3
            ),
            "appeal_success_probability": half_up(
                F.when(F.col("requires_appeal"), F.col("_p") * 0.7).otherwise(F.lit(0.0)), 3
            ),
            "provider_feedback_required": ~won & (F.col("raw_data_completeness_score") < 0.7),
            "bpo_roi": half_up(
                F.when(hours > 0, F.col("_fee") / (hours * HOURLY_COST) * 100.0).otherwise(
                    F.lit(0.0)
                ),
                2,
            ),
        }
    ).drop("_p", "_reimbursement", "_fee")


def processed(claims: DataFrame) -> DataFrame:
    return with_outcomes(with_billing(claims))
