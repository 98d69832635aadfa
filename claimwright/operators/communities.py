"""Groups of providers that share patients, over the table of patients and providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.session import settle

MAX_ROUNDS = 100


def ties(
    claims: DataFrame, min_claims: int = 1, patient: str = "patient_id", provider: str = "provider_id"
) -> DataFrame:
    """``patient, provider, claims`` of the pairs with at least ``min_claims`` claims.

    Null patients and null providers are unknown: they tie nothing together.
    """
    return (
        claims.filter(F.col(patient).isNotNull() & F.col(provider).isNotNull())
        .groupBy(F.col(patient).alias("patient"), F.col(provider).alias("provider"))
        .agg(F.count(F.lit(1)).alias("claims"))
        .filter(F.col("claims") >= min_claims)
    )


def _same(labels: DataFrame, changed: DataFrame) -> bool:
    """Whether two label tables agree, from one comparison of each provider's labels."""
    both = labels.select("provider", F.col("label").alias("_before")).join(changed, "provider")
    return both.filter(F.col("_before") != F.col("label")).isEmpty()


def provider_groups(
    claims: DataFrame,
    min_claims: int = 1,
    patient: str = "patient_id",
    provider: str = "provider_id",
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """Per provider the least provider that a chain of shared patients leads to, and the group's size.

    A patient ties together the providers with at least ``min_claims`` of their claims; a provider
    without such a tie is in no row. Labels spread over the patients: a round takes the least label
    of each patient's providers, then of each provider's patients, tells it to the provider that gave
    the old label, and follows labels of labels once. Both minima are combined before the shuffle,
    so a patient of many providers costs rows, not pairs, and the number of rounds grows with the
    logarithm of the longest chain. Each round is a stored table. More than ``max_rounds`` is an error.

    Returns ``provider, group_id, providers, patients, claims``, the last three of the whole group.
    """
    edges = settle(ties(claims, min_claims, patient, provider), "ties")
    labels = settle(
        edges.select("provider").distinct().withColumn("label", F.col("provider")), "labels"
    )
    for _ in range(max_rounds):
        known = edges.select("patient", "provider").join(labels, "provider")
        least = known.groupBy("patient").agg(F.min("label").alias("least"))
        heard = (
            edges.select("patient", "provider").join(least, "patient")
            .groupBy("provider").agg(F.min("least").alias("least"))
        )
        told = settle(labels.join(heard, "provider"), "told")
        # The provider whose name is the label learns the least label known to those that bear it.
        hooked = told.groupBy(F.col("label").alias("provider")).agg(F.min("least").alias("hook"))
        better = settle(
            told.join(hooked, "provider", "left").select(
                "provider", F.least("least", F.coalesce("hook", F.col("least"))).alias("label")
            ),
            "better",
        )
        further = better.select(F.col("provider").alias("label"), F.col("label").alias("_further"))
        spread = settle(
            better.join(further, "label").select("provider", F.col("_further").alias("label")), "labels"
        )
        if _same(labels, spread):
            break
        labels = spread
    else:
        raise RuntimeError(f"labels still spread after {max_rounds} rounds")
    per_provider = edges.groupBy("provider").agg(F.sum("claims").alias("claims"))
    sizes = labels.join(per_provider, "provider").groupBy("label").agg(
        F.count(F.lit(1)).alias("providers"), F.sum("claims").alias("claims")
    )
    patients = (
        edges.join(labels, "provider").groupBy("patient").agg(F.min("label").alias("label"))
        .groupBy("label").agg(F.count(F.lit(1)).alias("patients"))
    )
    return labels.join(sizes.join(patients, "label"), "label").select(
        "provider", F.col("label").alias("group_id"), "providers", "patients", "claims"
    )
