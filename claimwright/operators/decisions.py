"""Production decisions: approval probability, action, recommendations, money."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule, Scorecard, half_up, items_where
from claimwright.operators.labels import IN_NETWORK, OUT_OF_NETWORK

# Thresholds and defaults of the decision rules.
SUBMIT_THRESHOLD = 0.75
REVIEW_THRESHOLD = 0.65
HIGH_VALUE = 5000
DEFAULT_BILLED = 1000.0
DEFAULT_CODING = 0.9
DEFAULT_COMPLETENESS = 0.8
DEFAULT_DAYS = 14
FALLBACK_PROBABILITY = 0.75
FALLBACK_CONFIDENCE = 0.60
FALLBACK_NOTE = "Manual review required - model unavailable"


def approval_card(inputs: Inputs) -> Scorecard:
    """Approval probability from 0.8, clamped to [0.1, 0.98]."""
    coding = "coding_accuracy_score"
    network = inputs.text("network_status", IN_NETWORK)
    return Scorecard(
        base=0.8,
        rules=(
            Rule("coding_high", inputs.above(coding, 0.95, DEFAULT_CODING), 0.1),
            Rule("coding_low", inputs.below(coding, 0.85, DEFAULT_CODING), -0.2),
            Rule(
                "completeness",
                inputs.below("provider_data_completeness", 0.7, DEFAULT_COMPLETENESS),
                -0.15,
            ),
            Rule("authorization", inputs.flag("prior_authorization_obtained", False), 0.08),
            Rule("eligibility", inputs.flag("eligibility_verification_completed", True), 0.05),
            Rule("network", network == OUT_OF_NETWORK, -0.25),
            Rule("amount", inputs.above("billed_amount", HIGH_VALUE, DEFAULT_BILLED), -0.05),
            Rule("late", inputs.above("days_service_to_submission", 60, DEFAULT_DAYS), -0.1),
        ),
        low=0.1,
        high=0.98,
    )


def rejection_reason(inputs: Inputs) -> Column:
    """First matching reason. An absent authorization column counts as obtained here."""
    # Reason codes in order of precedence.
    return (
        F.when(~inputs.flag("prior_authorization_obtained", True), "missing_prior_authorization")
        .when(
            ~inputs.flag("eligibility_verification_completed", True),
            "eligibility_verification_failed",
        )
        .when(
            inputs.below("provider_data_completeness", 0.7, DEFAULT_COMPLETENESS),
            "insufficient_documentation",
        )
        .when(inputs.below("coding_accuracy_score", 0.85, DEFAULT_CODING), "incorrect_coding")
        .when(
            inputs.text("network_status", IN_NETWORK) == OUT_OF_NETWORK, "out_of_network_provider"
        )
        .when(
            inputs.above("days_service_to_submission", 90, DEFAULT_DAYS),
            "timely_filing_limit_exceeded",
        )
        .otherwise("medical_necessity_not_established")
    )


def recommendation_list(inputs: Inputs) -> Column:
    """The recommendations that apply, in fixed order."""
    # Recommendation texts.
    return items_where(
        [
            (
                inputs.below("coding_accuracy_score", 0.9, DEFAULT_CODING),
                F.lit("Review coding with senior coder"),
            ),
            (
                inputs.below("provider_data_completeness", 0.8, DEFAULT_COMPLETENESS),
                F.lit("Request additional documentation from provider"),
            ),
            (
                ~inputs.flag("prior_authorization_obtained", True),
                F.lit("Obtain prior authorization before submission"),
            ),
            (
                inputs.text("network_status", IN_NETWORK) == OUT_OF_NETWORK,
                F.lit("Verify out-of-network benefits"),
            ),
        ]
    )


def decision_action(probability: Column) -> Column:
    return (
        F.when(probability >= SUBMIT_THRESHOLD, "SUBMIT")
        .when(probability >= REVIEW_THRESHOLD, "QA_REVIEW")
        .otherwise("HOLD")
    )


def decision_priority(probability: Column, billed: Column) -> Column:
    return (
        F.when(
            probability >= SUBMIT_THRESHOLD,
            F.when(billed > HIGH_VALUE, "HIGH").otherwise("NORMAL"),
        )
        .when(probability >= REVIEW_THRESHOLD, "MEDIUM")
        .otherwise("LOW")
    )


def expected_reimbursement(probability: Column, billed: Column, network: Column) -> Column:
    """Billed x 0.8 in network, x 0.6 for anything else including null, x probability."""
    rate = F.when(network == IN_NETWORK, F.lit(0.8)).otherwise(F.lit(0.6))
    return half_up(billed * rate * probability, 2)


def unscorable(inputs: Inputs) -> Column:
    """Rows that take the fallback: a null service flag, or text in a numeric rule input."""
    tests = [
        inputs.null_in("prior_authorization_obtained"),
        inputs.null_in("eligibility_verification_completed"),
    ] + [
        inputs.unreadable_number(name)
        for name in (
            "coding_accuracy_score",
            "provider_data_completeness",
            "billed_amount",
            "days_service_to_submission",
        )
    ]
    return reduce(lambda a, b: a | b, tests)


def decide(claims: DataFrame, probability: Column | None = None, use_fallback: bool = False) -> DataFrame:
    """Input columns plus the decision columns and the nested ``recommendation``.

    ``probability`` replaces the rule-based probability, for example with a fitted model's.
    ``use_fallback`` gives every row the fallback decision, as when no model is loaded.
    Works on batch and streaming frames alike.
    """
    inputs = Inputs(claims)
    billed = inputs.number("billed_amount", DEFAULT_BILLED)
    network = inputs.text("network_status", IN_NETWORK)
    if probability is None:
        probability = approval_card(inputs).score()
    staged = claims.withColumns(
        {
            "_p": probability,
            "_fallback": F.lit(True) if use_fallback else unscorable(inputs),
        }
    )
    p, fallback = F.col("_p"), F.col("_fallback")

    def either(fallback_value, scored: Column) -> Column:
        return F.when(fallback, fallback_value).otherwise(scored)

    columns = {
        "approval_probability": either(F.lit(FALLBACK_PROBABILITY), half_up(p, 3)),
        "predicted_approved": either(F.lit(True), p > 0.5),
        "rejection_reason": F.when(~fallback & ~(p > 0.5), rejection_reason(inputs)),
        "confidence_score": either(
            F.lit(FALLBACK_CONFIDENCE), half_up(F.least(p, F.lit(1.0) - p) + 0.5, 3)
        ),
        "decision_margin": F.when(~fallback, F.abs(p - 0.5)),
        "recommendation": F.struct(
            either(F.lit("QA_REVIEW"), decision_action(p)).alias("action"),
            either(
                F.lit("MEDIUM"), decision_priority(p, inputs.number("billed_amount", 0.0))
            ).alias("priority"),
            either(
                F.array(F.lit(FALLBACK_NOTE)), recommendation_list(inputs)
            ).alias("recommendations"),
            either(billed * 0.75, expected_reimbursement(p, billed, network)).alias(
                "expected_reimbursement"
            ),
        ),
    }
    columns["claim_id"] = inputs.text("claim_id", "UNKNOWN")
    return staged.withColumns(columns).drop("_p", "_fallback")


def decision_facts(claims: DataFrame) -> DataFrame:
    """Only what the batch reports need: action, billed and expected money."""
    decided = decide(claims)
    return decided.select(
        F.col("recommendation.action").alias("action"),
        F.col("recommendation.expected_reimbursement").alias("expected_reimbursement"),
        "billed_amount",
    )


def model_inputs(claims: DataFrame) -> DataFrame:
    """The ten numeric model inputs with their defaults; flags and network as 0 or 1."""
    inputs = Inputs(claims)
    network = inputs.text("network_status", IN_NETWORK)
    # Input names and defaults.
    numbers = {
        "patient_age": inputs.number("patient_age", 45),
        "billed_amount": inputs.number("billed_amount", DEFAULT_BILLED),
        "coding_accuracy_score": inputs.number("coding_accuracy_score", DEFAULT_CODING),
        "provider_data_completeness": inputs.number(
            "provider_data_completeness", DEFAULT_COMPLETENESS
        ),
        "coder_experience_years": inputs.number("coder_experience_years", 5),
        "days_service_to_submission": inputs.number("days_service_to_submission", DEFAULT_DAYS),
        "prior_authorization": inputs.flag("prior_authorization_obtained", False),
        "eligibility_verified": inputs.flag("eligibility_verification_completed", True),
        "in_network": F.coalesce(network == IN_NETWORK, F.lit(False)),
        "documentation_enhancement_score": inputs.number("documentation_enhancement_score", 0.5),
    }
    return claims.withColumns(
        {f"x_{name}": value.cast("int").cast("double") if name in (
            "prior_authorization", "eligibility_verified", "in_network"
        ) else value.cast("double") for name, value in numbers.items()}
    )
