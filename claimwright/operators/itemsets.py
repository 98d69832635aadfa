"""Codes that occur together in a patient's claims of a period: frequent sets, rules, unusual sets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.session import settle

ITEM_COLUMNS = ("primary_diagnosis_code", "procedure_code")


def baskets(
    claims: DataFrame,
    period: Column | None = None,
    patient: str = "patient_id",
    codes: tuple[str, ...] = ITEM_COLUMNS,
) -> DataFrame:
    """``patient, period, items``: the distinct codes of a patient in a calendar year.

    Distinct codes are found by a combinable group-by first, so a basket is as long as the code
    lists at most, however many claims the patient has. Null codes are no items; claims of an unknown
    patient or without a date are in no basket.
    """
    period = F.year("service_date") if period is None else period
    found = claims.select(
        F.col(patient).alias("patient"),
        period.alias("period"),
        F.explode(F.array_compact(F.array(*[F.col(c).cast("string") for c in codes]))).alias("item"),
    )
    found = found.filter("patient is not null and period is not null").distinct()
    return found.groupBy("patient", "period").agg(F.sort_array(F.collect_list("item")).alias("items"))


def fit(baskets: DataFrame, min_support: float, min_confidence: float = 0.5) -> FPGrowthModel:
    """FP-growth over the baskets; they are stored, as it reads them more than once."""
    return FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(settle(baskets.select("items"), "baskets"))


def frequent_sets(model: FPGrowthModel, most: int = 3) -> DataFrame:
    """``items`` (sorted) and ``baskets`` that hold them, of sets of up to ``most`` codes."""
    return model.freqItemsets.filter(F.size("items") <= most).select(
        F.sort_array("items").alias("items"), F.col("freq").alias("baskets")
    )


def code_rules(model: FPGrowthModel, most: int = 3) -> DataFrame:
    """``antecedent`` (sorted), ``consequent``, confidence and lift of rules over ``most`` codes at most."""
    return model.associationRules.filter(F.size("antecedent") < most).select(
        F.sort_array("antecedent").alias("antecedent"),
        F.element_at("consequent", 1).alias("consequent"),
        "confidence",
        "lift",
    )


def unusual_sets(sets: DataFrame, total: int, most_ratio: float = 0.9) -> DataFrame:
    """Sets that are much rarer than their codes, each frequent by itself, would suggest.

    ``ratio`` is the count over the one expected if codes were independent; sets up to ``most_ratio``
    are returned. Each set meets the counts of its own codes only.
    """
    sets = settle(sets, "sets")
    single = sets.filter(F.size("items") == 1).select(
        F.element_at("items", 1).alias("item"), F.col("baskets").cast("double").alias("alone")
    )
    parts = sets.filter(F.size("items") > 1).select("items", "baskets", F.explode("items").alias("item"))
    shares = F.sort_array(F.collect_list(F.struct("item", (F.col("alone") / total).alias("share"))))
    product = F.aggregate("shares", F.lit(1.0), lambda done, s: done * s["share"])
    return (
        parts.join(single, "item").groupBy("items", "baskets").agg(shares.alias("shares"))
        .select("items", "baskets", (F.col("baskets") / (product * total)).alias("ratio"))
        .filter(F.col("ratio") <= most_ratio)
    )
