"""Grouped and whole-table reports. Each report section is one DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.functions import (
    exact_mean,
    exact_sum,
    half_up,
    mean_of_flag,
    ratio_or_zero,
    share,
)

_ALL = "*"


def _zero_sum(value: Column) -> Column:
    return F.coalesce(exact_sum(value), F.lit(0.0))


# ---- ingest statistics -----------------------------------------------------------------


def claims_statistics(claims: DataFrame) -> DataFrame:
    """One row of counts, averages, date range and distinct patients and providers."""
    totals = claims.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if("is_rejected").alias("rejected_claims"),
        F.avg(F.col("patient_age").cast("double")).alias("age"),
        exact_mean(F.col("billed_amount")).alias("billed"),
        exact_mean(F.col("risk_score")).alias("risk"),
        F.min("service_date").alias("earliest_service"),
        F.max("service_date").alias("latest_service"),
    )
    # Each distinct count by itself: several in one aggregate would repeat every claim for each of them.
    patients, providers = (
        claims.select(c).distinct().agg(F.count(c)).scalar() for c in ("patient_id", "provider_id")
    )
    rate = share(F.col("rejected_claims"), F.col("total_claims"))
    return totals.select(
        "total_claims",
        "rejected_claims",
        half_up(rate * 100.0, 2).alias("rejection_rate_percent"),
        ratio_or_zero(half_up(F.col("age"), 1)).alias("avg_patient_age"),
        ratio_or_zero(half_up(F.col("billed"), 2)).alias("avg_billed_amount"),
        ratio_or_zero(half_up(F.col("risk"), 3)).alias("avg_risk_score"),
        "earliest_service",
        "latest_service",
        patients.alias("unique_patients"),
        providers.alias("unique_providers"),
    )


def rejection_analysis(claims: DataFrame) -> DataFrame:
    """Count and average amount per rejection reason, most frequent first.

    Claims are counted conditionally instead of filtered first: a filter on a computed
    label would be copied into the scan side of every join below it.
    """
    counted = F.col("is_rejected") & F.col("rejection_reason").isNotNull()
    return (
        claims.groupBy(F.col("rejection_reason").alias("reason"))
        .agg(
            F.count_if(counted).alias("claims"),
            ratio_or_zero(
                half_up(exact_mean(F.when(counted, F.col("billed_amount"))), 2)
            ).alias("avg_amount"),
        )
        .filter(F.col("claims") > 0)
        .orderBy(F.desc("claims"), "reason")
    )


def specialty_analysis(claims: DataFrame) -> DataFrame:
    """Claims, rejections, rejection percentage and average amount per specialty."""
    return (
        claims.groupBy(F.col("provider_specialty").alias("specialty"))
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.count_if("is_rejected").alias("rejected_claims"),
            ratio_or_zero(half_up(exact_mean(F.col("billed_amount")), 2)).alias("avg_amount"),
        )
        .withColumn(
            "rejection_rate",
            half_up(share(F.col("rejected_claims"), F.col("total_claims")) * 100.0, 2),
        )
        .orderBy(F.desc("total_claims"), "specialty")
    )


def application_stats(applications: DataFrame) -> DataFrame:
    """Count, application date range, average age and charges."""
    return applications.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("application_date").alias("earliest_date"),
        F.max("application_date").alias("latest_date"),
        ratio_or_zero(half_up(F.avg(F.col("age").cast("double")), 1)).alias("avg_age"),
        ratio_or_zero(half_up(exact_mean(F.col("charges")), 2)).alias("avg_charges"),
    )


# ---- screening reports -----------------------------------------------------------------


def pay_rate_summary(screened: DataFrame) -> DataFrame:
    totals = screened.agg(
        F.count(F.lit(1)).alias("total_claims_screened"),
        F.count_if("screening_submit_recommendation").alias("approved_for_submission"),
        _zero_sum(F.col("billed_amount")).alias("total_billed_amount"),
        _zero_sum(F.col("estimated_reimbursement")).alias("expected_reimbursement"),
    )
    approved, total = F.col("approved_for_submission"), F.col("total_claims_screened")
    return totals.select(
        "total_claims_screened",
        "approved_for_submission",
        (total - approved).alias("held_for_review"),
        half_up(share(approved, total), 3).alias("submission_rate"),
        "total_billed_amount",
        "expected_reimbursement",
        half_up(share(F.col("expected_reimbursement"), F.col("total_billed_amount")), 3).alias(
            "expected_pay_rate"
        ),
    )


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("claims"))
        .orderBy(F.desc("claims"), column)
    )


def top_slots(slots: DataFrame, name: str, k: int = 10, with_share: bool = False) -> DataFrame:
    """The ``k`` most frequent entries of the ``slots`` arrays.

    For the share of all claims every claim also emits one marker entry. Its count is the
    number of claims, at least as large as any other, so it is among the first ``k + 1``
    rows and the total needs no second pass. The window below sees only those rows.
    """
    entries = F.concat(F.array(F.lit(_ALL)), F.col("slots")) if with_share else F.col("slots")
    counts = (
        slots.select(F.explode(entries).alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("claims"))
    )
    if not with_share:
        return counts.orderBy(F.desc("claims"), name).limit(k)
    head = counts.orderBy(F.desc("claims"), F.col(name) != _ALL, name).limit(k + 1)
    total = F.max(F.when(F.col(name) == _ALL, F.col("claims"))).over(Window.partitionBy())
    return (
        head.withColumn("percentage", half_up(F.col("claims") / total * 100.0, 1))
        .filter(F.col(name) != _ALL)
    )


# ---- decision reports ------------------------------------------------------------------


def batch_summary(facts: DataFrame) -> DataFrame:
    """Totals by action and money, from ``decision_facts``."""
    totals = facts.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(F.col("action") == "SUBMIT").alias("submit_count"),
        F.count_if(F.col("action") == "QA_REVIEW").alias("qa_review_count"),
        F.count_if(F.col("action") == "HOLD").alias("hold_count"),
        _zero_sum(F.col("billed_amount")).alias("total_billed"),
        _zero_sum(F.col("expected_reimbursement")).alias("expected_reimbursement"),
    )
    return totals.withColumns(
        {
            "submission_rate": half_up(share(F.col("submit_count"), F.col("total_claims")), 3),
            "expected_pay_rate": half_up(
                share(F.col("expected_reimbursement"), F.col("total_billed")), 3
            ),
        }
    )


def dashboard_metrics(facts: DataFrame) -> DataFrame:
    """The dashboard figures as ``(metric, value)`` rows."""
    total = F.col("total_claims")
    row = batch_summary(facts).withColumns(
        {
            "quality_gate": share(F.col("submit_count") + F.col("qa_review_count"), total),
            "claims_per_hour": total / F.lit(8.0),
        }
    )
    names = [
        "total_claims",
        "submit_count",
        "qa_review_count",
        "hold_count",
        "submission_rate",
        "total_billed",
        "expected_reimbursement",
        "expected_pay_rate",
        "quality_gate",
        "claims_per_hour",
    ]
    return row.select([F.col(n).cast("double").alias(n) for n in names]).unpivot(
        [], names, "metric", "value"
    )


# ---- processing reports ----------------------------------------------------------------


def performance_overall(processed: DataFrame) -> DataFrame:
    totals = processed.agg(
        F.count(F.lit(1)).alias("total_claims_processed"),
        F.count_if("claim_successful").alias("successful"),
        _zero_sum(F.col("final_billed_amount")).alias("billed"),
        _zero_sum(F.col("actual_reimbursement")).alias("collected"),
        _zero_sum(F.col("bpo_fee_earned")).alias("fees"),
        F.avg(F.col("bpo_processing_hours").cast("double")).alias("hours"),
        mean_of_flag(F.col("turnaround_sla_met")).alias("sla"),
    )
    return totals.select(
        "total_claims_processed",
        half_up(share(F.col("successful"), F.col("total_claims_processed")), 3).alias(
            "success_rate"
        ),
        half_up(share(F.col("collected"), F.col("billed")), 3).alias("net_collection_rate"),
        half_up(F.col("collected"), 2).alias("total_revenue_collected"),
        half_up(F.col("fees"), 2).alias("total_bpo_fees_earned"),
        half_up(F.col("hours"), 2).alias("avg_processing_hours"),
        half_up(F.col("sla"), 3).alias("sla_compliance_rate"),
    )


def performance_quality(processed: DataFrame) -> DataFrame:
    return processed.agg(
        half_up(exact_mean(F.col("coding_accuracy_score")), 3).alias("avg_coding_accuracy"),
        half_up(exact_mean(F.col("raw_data_completeness_score")), 3).alias(
            "avg_raw_data_completeness"
        ),
        half_up(exact_mean(F.col("client_satisfaction_score")), 2).alias(
            "avg_client_satisfaction"
        ),
        half_up(mean_of_flag(F.col("qa_review_required")), 3).alias("qa_review_rate"),
    )


def top_coders(processed: DataFrame, k: int = 5) -> DataFrame:
    return (
        processed.filter(F.col("assigned_coder").isNotNull())
        .groupBy("assigned_coder")
        .agg(
            mean_of_flag(F.col("claim_successful")).alias("success_rate"),
            _zero_sum(F.col("bpo_fee_earned")).alias("fees_earned"),
            exact_mean(F.col("coding_accuracy_score")).alias("coding_accuracy"),
        )
        .orderBy(F.desc("success_rate"), "assigned_coder")
        .limit(k)
    )


def coder_kpis(processed: DataFrame) -> DataFrame:
    """Claims and fees per processing hour, collection and confidence figures per coder."""
    sums = (
        processed.filter(F.col("assigned_coder").isNotNull())
        .groupBy("assigned_coder")
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.sum(F.col("bpo_processing_hours").cast("long")).alias("hours"),
            _zero_sum(F.col("bpo_fee_earned")).alias("fees"),
            _zero_sum(F.col("final_billed_amount")).alias("billed"),
            _zero_sum(F.col("actual_reimbursement")).alias("collected"),
            exact_mean(F.col("client_satisfaction_score")).alias("client_satisfaction"),
            exact_mean(F.col("documentation_enhancement_score")).alias("documentation_score"),
        )
    )
    return sums.select(
        "assigned_coder",
        "claims",
        share(F.col("claims"), F.col("hours")).alias("claims_per_hour"),
        share(F.col("fees"), F.col("hours")).alias("fee_per_hour"),
        share(F.col("collected"), F.col("billed")).alias("pay_rate"),
        "client_satisfaction",
        "documentation_score",
    )


def payor_specialty_kpis(processed: DataFrame) -> DataFrame:
    """KPIs by payor, by specialty, by both and overall (``cube``); null marks a total."""
    return (
        processed.cube("primary_payor", "provider_specialty")
        .agg(
            F.grouping_id().cast("long").alias("level"),
            F.count(F.lit(1)).alias("claims"),
            mean_of_flag(F.col("claim_successful")).alias("success_rate"),
            _zero_sum(F.col("final_billed_amount")).alias("billed"),
            _zero_sum(F.col("actual_reimbursement")).alias("collected"),
        )
        .withColumn("pay_rate", share(F.col("collected"), F.col("billed")))
    )


# ---- training-table reports ------------------------------------------------------------


def training_summary(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count(F.lit(1)).alias("total_claims"),
        mean_of_flag(F.col("is_approved")).alias("approval_rate"),
        exact_mean(F.col("approval_probability_actual")).alias("avg_approval_probability"),
    )


def shares_of(
    frame: DataFrame, column: str, k: int | None = None, among: Column | None = None
) -> DataFrame:
    """Counts of each non-null value with its share of all rows, or of the rows in ``among``.

    The total adds up the per-value counts; its subquery reuses their shuffle.
    """
    among = F.lit(True) if among is None else among
    counts = frame.groupBy(column).agg(
        F.count_if(among).alias("_rows"),
        F.count_if(among & F.col(column).isNotNull()).alias("claims"),
    )
    total = counts.agg(F.sum("_rows").alias("total")).scalar()
    shares = (
        counts.filter(F.col("claims") > 0)
        .select(column, "claims", (F.col("claims") / total).alias("share"))
        .orderBy(F.desc("claims"), column)
    )
    return shares if k is None else shares.limit(k)


def label_rates(frame: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Rate of a boolean label and exact distinct counts of ``columns``."""
    return frame.agg(
        F.count(F.lit(1)).alias("total"),
        mean_of_flag(F.col(label)).alias(f"{label}_rate"),
        *[F.count_distinct(c).alias(f"{c}_values") for c in columns],
    )


def revenue_impact(accuracy: DataFrame) -> DataFrame:
    """Projected approval rate and improvement for each row's ``accuracy``."""
    current = 0.85
    projected = F.least(F.lit(0.95), F.lit(current) + (F.col("accuracy") - 0.5) * 0.2)
    return (
        accuracy.withColumn("current_approval_rate", F.lit(current))
        .withColumn("projected_approval_rate", projected)
        .withColumn("improvement", F.col("projected_approval_rate") - F.lit(current))
    )
