"""Pre-submission screening of medical claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule, Scorecard, half_up
from claimwright.operators.labels import OUT_OF_NETWORK

# Thresholds of the screening rules.
SUBMIT_THRESHOLD = 0.85
HIGH_VALUE = 5000
DOCUMENT_THRESHOLD = 0.8


def coding_accuracy(inputs: Inputs) -> Column:
    """0.95 less deductions for implausible codes, at least 0.5. A null code counts as ''."""
    diagnosis = F.coalesce(inputs.text("primary_diagnosis_code", ""), F.lit(""))
    procedure = F.coalesce(inputs.text("procedure_code", ""), F.lit(""))
    age = inputs.number("patient_age", 0)
    gender = inputs.text("patient_gender", "")
    child_code = F.lower(diagnosis).contains("pediatric") & (age > 18)
    birth_code = (gender == "M") & (
        diagnosis.contains("pregnancy") | diagnosis.contains("obstetric")
    )
    short_code = (F.length(diagnosis) < 3) | (F.length(procedure) < 3)
    return Scorecard(
        base=0.95,
        rules=(
            Rule("child_code", child_code, -0.2),
            Rule("birth_code", birth_code, -0.3),
            Rule("short_code", short_code, -0.1),
        ),
        low=0.5,
    ).score()


def medical_necessity(inputs: Inputs) -> Column:
    """Documentation quality scaled by 0.9, or by 0.1 less for a high-value claim."""
    base = Scorecard(
        0.9, (Rule("high_value", inputs.above("billed_amount", HIGH_VALUE, 0), -0.1),)
    ).score()
    return base * inputs.number("documentation_quality_score", 0.8)


def unusual_amount(inputs: Inputs) -> Column:
    zscore = inputs.number("billed_amount_zscore", 0)
    large = inputs.above("billed_amount", 20000, 0)
    return F.coalesce(F.abs(zscore) > 2.0, F.lit(False)) | F.coalesce(large, F.lit(False))


def delayed(inputs: Inputs) -> Column:
    return inputs.above("days_to_submission", 60, 0)


def _fixed_point(value: Column, places: int) -> Column:
    return half_up(value, places).cast(f"decimal(18,{places})").cast("string")


def screening_card(inputs: Inputs) -> Scorecard:
    """Eight ordered deductions from 1.0, each with its label and recommendation."""
    documents = inputs.number("documentation_quality_score", 0)
    patient_rate = inputs.number("patient_rejection_rate", 0)
    # Labels and recommendations of the rules.
    return Scorecard(
        base=1.0,
        rules=(
            Rule(
                "network",
                inputs.text("provider_network_status") == OUT_OF_NETWORK,
                -0.3,
                "Out-of-network provider",
                action="Verify patient has out-of-network benefits",
            ),
            Rule(
                "documents",
                inputs.below("documentation_quality_score", DOCUMENT_THRESHOLD, 0),
                -0.25,
                "Poor documentation quality",
                _fixed_point(documents, 2),
                "Request additional documentation from provider",
            ),
            Rule(
                "coding",
                coding_accuracy(inputs) < 0.9,
                -0.2,
                "Potential coding errors detected",
                action="Review codes with certified medical coder",
            ),
            Rule(
                "necessity",
                medical_necessity(inputs) < 0.8,
                -0.25,
                "Medical necessity questionable",
                action="Obtain supporting clinical documentation",
            ),
            Rule(
                "amount",
                unusual_amount(inputs),
                -0.15,
                "Unusual billing amount detected",
                action="Verify charges against fee schedule",
            ),
            Rule(
                "timing",
                delayed(inputs),
                -0.1,
                "Delayed submission - may exceed timely filing",
                action="Submit immediately or check timely filing limits",
            ),
            Rule(
                "patient",
                inputs.above("patient_rejection_rate", 0.2, 0),
                -0.1,
                "Patient has high rejection history",
                F.concat(_fixed_point(patient_rate * 100.0, 1), F.lit("%")),
                "Extra scrutiny - patient has rejection history",
            ),
            Rule(
                "specialty",
                inputs.above("provider_specialty_risk", 0.25, 0),
                -0.1,
                "Provider specialty has high rejection rate",
                action="Follow specialty-specific submission guidelines",
            ),
        ),
        low=0.0,
    )


def processing_priority(score: Column, billed: Column) -> Column:
    return (
        F.when((score >= 0.95) & (billed > 1000), "HIGH_PRIORITY_CLEAN")
        .when(score < 0.7, "HOLD_FOR_REVIEW")
        .when(billed > HIGH_VALUE, "HIGH_VALUE_REVIEW")
        .otherwise("STANDARD_PROCESSING")
    )


def expected_reimbursement(score: Column, billed: Column, network: Column) -> Column:
    """Billed x rate x score; the rate is 0.8, times 0.6 when out of network."""
    rate = F.when(network == OUT_OF_NETWORK, F.lit(0.8 * 0.6)).otherwise(F.lit(0.8))
    return half_up(billed * rate * score, 2)


def screen(
    claims: DataFrame, card: Scorecard | None = None, keep_arrays: bool = False
) -> DataFrame:
    """Input columns plus six screening columns.

    Works on batch and streaming frames alike. ``card`` replaces the standard rules, for
    example with ``screening_card(Inputs(claims)).extended(...)``. ``keep_arrays`` keeps the
    factors and recommendations as arrays instead of text joined by ``'; '``.
    """
    inputs = Inputs(claims)
    card = card or screening_card(inputs)
    billed = inputs.number("billed_amount", 0)
    flagged = card.with_flags(claims).withColumn("_score", card.score_from_flags())
    score = F.col("_score")
    screened = flagged.withColumns(
        {
            "screening_approval_probability": half_up(score, 3),
            "screening_risk_factors": card.labels() if keep_arrays else card.label_text(),
            "screening_recommendations": card.actions() if keep_arrays else card.action_text(),
            "screening_submit_recommendation": (score >= SUBMIT_THRESHOLD)
            & ~card.any_label_mentions("missing"),
            "estimated_reimbursement": expected_reimbursement(
                score, billed, inputs.text("provider_network_status")
            ),
            "processing_priority": processing_priority(score, billed),
        }
    )
    return card.without_flags(screened).drop("_score")


def risk_factor_slots(claims: DataFrame, with_detail: bool = True) -> DataFrame:
    """One array per claim with a slot per rule, for counting without splitting text."""
    card = screening_card(Inputs(claims))
    return card.with_flags(claims).select(card.label_slots(with_detail).alias("slots"))


def recommendation_slots(claims: DataFrame) -> DataFrame:
    card = screening_card(Inputs(claims))
    return card.with_flags(claims).select(card.action_slots().alias("slots"))
