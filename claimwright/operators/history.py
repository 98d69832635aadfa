"""Features from the claim history of patients, providers and codes.

Claims are first counted per entity and day (or month), so a window never holds more than
one row per calendar day of an entity, however many claims the entity has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.functions import exact_mean, exact_sum, known, mean_of_flag
from claimwright.session import attach_lookup, null_safe_left_join, settle

DAY = "service_date"


def _days(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date"))


def _earlier(*keys: str):
    return Window.partitionBy(*keys).orderBy("_day")


def with_day(claims: DataFrame) -> DataFrame:
    return claims.withColumn("_day", _days(DAY))


def days_since_last_claim(claims: DataFrame, entity: str = "patient_id") -> DataFrame:
    """Days since the entity's previous claim day; null on its first day.

    Claims without an entity count as one entity's, and those without a date have no days.
    """
    dated = with_day(claims)
    days = dated.select(entity, "_day").distinct()
    gaps = days.withColumn(
        "days_since_last_claim", F.col("_day") - F.lag("_day").over(_earlier(entity))
    )
    return null_safe_left_join(dated, gaps, [entity, "_day"]).drop("_day")


def provider_monthly_trend(claims: DataFrame, provider: str = "provider_id") -> DataFrame:
    """Claims per provider and month, change to the previous one, and 3-month mean."""
    months = (
        claims.withColumn("month", F.trunc(F.col(DAY).cast("date"), "month"))
        .groupBy(provider, "month")
        .agg(F.count(F.lit(1)).alias("claims"))
    )
    order = Window.partitionBy(provider).orderBy("month")
    return months.withColumns(
        {
            "change": F.col("claims") - F.lag("claims").over(order),
            "three_month_mean": F.sum("claims").over(order.rowsBetween(-2, 0))
            / F.count("claims").over(order.rowsBetween(-2, 0)),
        }
    )


def diagnosis_seasonality(claims: DataFrame, code: str = "primary_diagnosis_code") -> DataFrame:
    """Claims per diagnosis and calendar month with the month's share of the diagnosis."""
    months = claims.groupBy(code, F.month(DAY).alias("month")).agg(F.count(F.lit(1)).alias("claims"))
    whole = Window.partitionBy(code)
    return months.withColumn("share", F.col("claims") / F.sum("claims").over(whole))


def with_provider_history(
    claims: DataFrame, provider: str = "provider_id", label: str = "is_rejected"
) -> DataFrame:
    """The provider's claims and rejection rate on all earlier days; null without any.

    Claims without a provider count as one provider's.
    """
    dated = with_day(claims)
    days = dated.groupBy(provider, "_day").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(label).alias("_rejected")
    )
    before = _earlier(provider).rowsBetween(Window.unboundedPreceding, -1)
    history = days.select(
        provider,
        "_day",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("earlier_claims"),
        (F.sum("_rejected").over(before) / F.sum("_n").over(before)).alias(
            "earlier_rejection_rate"
        ),
    )
    return null_safe_left_join(dated, history, [provider, "_day"]).drop("_day")


def peer_deviation(
    claims: DataFrame,
    provider: str = "provider_id",
    group: str = "provider_specialty",
    label: str = "is_rejected",
) -> DataFrame:
    """Each provider's rejection rate and its difference from the specialty's."""
    providers = claims.groupBy(provider, group).agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(label).alias("rejected")
    )
    peers = providers.groupBy(group).agg(
        (F.sum("rejected") / F.sum("claims")).alias("peer_rate")
    )
    rate = F.col("rejected") / F.col("claims")
    return attach_lookup(providers, peers, [group]).select(
        provider,
        group,
        "claims",
        rate.alias("rejection_rate"),
        (rate - F.col("peer_rate")).alias("deviation"),
    )


def billing_consistency(claims: DataFrame, provider: str = "provider_id") -> DataFrame:
    """Mean billed amount and coefficient of variation per provider."""
    return claims.groupBy(provider).agg(
        F.count(F.lit(1)).alias("claims"),
        exact_mean(F.col("billed_amount")).alias("mean_amount"),
        F.try_divide(
            F.stddev_samp(known(F.col("billed_amount"))), F.avg(known(F.col("billed_amount")))
        ).alias("variation"),
    )


def provider_network(
    claims: DataFrame, patient: str = "patient_id", provider: str = "provider_id"
) -> DataFrame:
    """Patients, shared patients and links to other providers, per provider.

    A link is another provider seen by the same patient, counted once per patient. Links
    are summed from the number of providers of each patient; no pairs are formed.
    """
    seen = settle(claims.select(patient, provider).distinct(), "seen")
    per_patient = seen.groupBy(patient).agg(F.count(F.lit(1)).alias("providers"))
    return (
        attach_lookup(seen, per_patient, [patient], null_safe=True)
        .groupBy(provider)
        .agg(
            F.count(F.lit(1)).alias("patients"),
            F.count_if(F.col("providers") > 1).alias("shared_patients"),
            F.sum(F.col("providers") - 1).alias("links"),
        )
    )


def claim_frequency(claims: DataFrame, entity: str = "patient_id", days: int = 90) -> DataFrame:
    """Per claim day of the entity: claims on it and in the ``days`` days up to it."""
    per_day = with_day(claims).groupBy(entity, "_day").agg(F.count(F.lit(1)).alias("claims"))
    recent = _earlier(entity).rangeBetween(-(days - 1), 0)
    return per_day.select(
        entity,
        F.date_from_unix_date("_day").alias("day"),
        "claims",
        F.sum("claims").over(recent).alias("recent_claims"),
    )


def amount_trend(claims: DataFrame, entity: str = "patient_id") -> DataFrame:
    """Least-squares slope of billed amount per day; null with a single claim day.

    From exact sums of whole numbers, so the result does not depend on row order.
    """
    x = _days(DAY).cast("decimal(10,0)")
    y = F.floor(F.col("billed_amount") * 10000.0 + 0.5).cast("decimal(18,0)")
    sums = (
        claims.filter(known(F.col("billed_amount")).isNotNull() & F.col(DAY).isNotNull())
        .groupBy(entity)
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.sum(x).cast("double").alias("sx"),
            F.sum(y).cast("double").alias("sy"),
            F.sum(x * x).cast("double").alias("sxx"),
            F.sum(x * y).cast("double").alias("sxy"),
        )
    )
    n = F.col("claims").cast("double")
    spread = n * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), spread) / 10000.0
    return sums.select(entity, "claims", F.when(spread > 0, slope).alias("slope"))


def geographic_movement(
    claims: DataFrame, place: str, entity: str = "patient_id"
) -> DataFrame:
    """Claim days, places and moves per entity.

    A move is a claim day that starts in another place than the last one ended; the
    places of one day are taken in alphabetical order.
    """
    days = with_day(claims).groupBy(entity, "_day").agg(
        F.min(place).alias("_first"), F.max(place).alias("_last")
    )
    moved = F.col("_first") != F.lag("_last").over(_earlier(entity))
    moves = days.withColumn("_moved", moved).groupBy(entity).agg(
        F.count(F.lit(1)).alias("claim_days"), F.count_if("_moved").alias("moves")
    )
    return moves


def code_lift(
    claims: DataFrame, left: str = "primary_diagnosis_code", right: str = "procedure_code"
) -> DataFrame:
    """Pair count and lift of diagnosis and procedure: observed over expected frequency.

    A null code is a code of its own. The windows run over one row per pair of codes.
    """
    pairs = settle(claims.groupBy(left, right).agg(F.count(F.lit(1)).alias("claims")), "pairs")
    total = pairs.agg(F.sum("claims")).scalar()
    lefts = F.sum("claims").over(Window.partitionBy(left)).cast("double")
    rights = F.sum("claims").over(Window.partitionBy(right)).cast("double")
    expected = F.col("_left") * F.col("_right")
    return pairs.withColumn("_left", lefts).withColumn("_right", rights).select(
        left,
        right,
        "claims",
        (F.col("claims").cast("double") * total.cast("double") / expected).alias("lift"),
    )


def diagnosis_complexity(
    claims: DataFrame,
    chronic: Sequence[str],
    entity: str = "patient_id",
    code: str = "primary_diagnosis_code",
) -> DataFrame:
    """Distinct diagnoses, chapters and chronic conditions per entity.

    Distinct pairs are formed first, so an entity's copies of a code count as one row.
    """
    pairs = claims.select(entity, code).filter(F.col(code).isNotNull()).distinct()
    is_chronic = F.col(code).isin(list(chronic))
    return pairs.groupBy(entity).agg(
        F.count(F.lit(1)).alias("diagnoses"),
        F.count_distinct(F.substring(code, 1, 1)).alias("chapters"),
        F.count_if(is_chronic).alias("chronic_conditions"),
        (F.count_if(is_chronic) > 1).alias("comorbid"),
    )


def with_age_band(
    claims: DataFrame, code: str = "procedure_code", low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """The usual age range of the procedure and whether the patient is outside it.

    Percentiles are taken over the counts per age, not over the claims. A null code is a
    procedure of its own.
    """
    ages = claims.groupBy(code, "patient_age").agg(F.count(F.lit(1)).alias("_n"))
    bands = ages.groupBy(code).agg(
        F.percentile("patient_age", [low, high], F.col("_n")).alias("_band")
    )
    bands = bands.select(
        code, F.get("_band", F.lit(0)).alias("age_low"), F.get("_band", F.lit(1)).alias("age_high")
    )
    outside = (F.col("patient_age") < F.col("age_low")) | (F.col("patient_age") > F.col("age_high"))
    return attach_lookup(claims, bands, [code], null_safe=True).withColumn("age_unusual", outside)


def with_gender_share(
    claims: DataFrame,
    code: str = "procedure_code",
    gender: str = "patient_gender",
    unusual_below: float = 0.05,
) -> DataFrame:
    """The share of the patient's gender among the procedure's claims, and whether it is unusual.

    Null codes and genders are values of their own.
    """
    counts = claims.groupBy(code, gender).agg(F.count(F.lit(1)).alias("_n"))
    rates = counts.select(
        code, gender, (F.col("_n") / F.sum("_n").over(Window.partitionBy(code))).alias("gender_share")
    )
    return attach_lookup(claims, rates, [code, gender], null_safe=True).withColumn(
        "gender_unusual", F.col("gender_share") < unusual_below
    )


def with_amount_norms(
    claims: DataFrame,
    diagnosis: str = "primary_diagnosis_code",
    procedure: str = "procedure_code",
) -> DataFrame:
    """Amount against the diagnosis norm (z-score) and the procedure's mean (ratio).

    One pass over the claims gives a small table per pair of codes, from which both norms
    are put together, and one pass joins them back. NaN amounts are left out and get null.
    """
    amount = known(F.col("billed_amount"))
    units = F.floor(amount * 10000.0 + 0.5).cast("decimal(18,0)")
    cells = settle(
        claims.groupBy(diagnosis, procedure).agg(
            F.count(amount).alias("_n"),
            F.avg(amount).alias("_mean"),
            F.var_pop(amount).alias("_spread"),
            F.sum(units).alias("_units"),
        ),
        "amounts",
    ).filter("_n > 0")
    whole = Window.partitionBy(diagnosis)
    centre = F.sum(F.col("_n") * F.col("_mean")).over(whole) / F.sum("_n").over(whole)
    norms = (
        cells.withColumn("_centre", centre)
        .groupBy(diagnosis)
        .agg(
            F.first("_centre").alias("_mean"),
            F.sum("_n").alias("_n"),
            F.sum(
                F.col("_n") * (F.col("_spread") + F.pow(F.col("_mean") - F.col("_centre"), F.lit(2)))
            ).alias("_squares"),
        )
        .select(
            diagnosis, "_mean", F.sqrt(F.try_divide(F.col("_squares"), F.col("_n") - 1)).alias("_std")
        )
    )
    market = cells.groupBy(procedure).agg(
        (F.sum("_units").cast("double") / 10000.0 / F.sum("_n").cast("double")).alias("_market")
    )
    joined = attach_lookup(claims, norms, [diagnosis], null_safe=True)
    joined = attach_lookup(joined, market, [procedure], null_safe=True)
    return joined.withColumns(
        {
            "diagnosis_zscore": F.try_divide(amount - F.col("_mean"), F.col("_std")),
            "market_ratio": F.try_divide(amount, F.col("_market")),
        }
    ).drop("_mean", "_std", "_market")


def rare_combinations(
    claims: DataFrame, columns: Sequence[str], below: float = 0.01
) -> DataFrame:
    """Value combinations that make up less than ``below`` of all claims."""
    counts = claims.groupBy(*columns).agg(F.count(F.lit(1)).alias("claims"))
    total = counts.agg(F.sum("claims")).scalar()
    return counts.withColumn("share", F.col("claims") / total).filter(F.col("share") < below)


def cost_escalation(claims: DataFrame, entity: str = "patient_id") -> DataFrame:
    """Mean amount per claim day of the entity and its change from the previous one."""
    days = with_day(claims).groupBy(entity, "_day").agg(
        exact_mean(F.col("billed_amount")).alias("mean_amount")
    )
    change = F.col("mean_amount") - F.lag("mean_amount").over(_earlier(entity))
    return days.select(
        entity, F.date_from_unix_date("_day").alias("day"), "mean_amount", change.alias("change")
    )


def urgency(claims: DataFrame, days: str = "days_to_submission") -> DataFrame:
    """Rejection rate by time between service and submission."""
    band = (
        F.when(F.col(days) <= 7, "week")
        .when(F.col(days) <= 30, "month")
        .when(F.col(days) <= 60, "two months")
        .otherwise("later")
    )
    return claims.groupBy(band.alias("urgency")).agg(
        F.count(F.lit(1)).alias("claims"),
        mean_of_flag(F.col("is_rejected")).alias("rejection_rate"),
        exact_sum(F.col("billed_amount")).alias("billed"),
    )
