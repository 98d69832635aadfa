"""Whole-table and per-group statistics mapped back to each claim."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.functions import known, mean_of_flag
from claimwright.session import BROADCAST_ROWS, attach_lookup, settle

_TOTAL_LEVEL = 1


def claim_baselines(
    claims: DataFrame,
    group: str = "provider_specialty",
    amount: str = "billed_amount",
    label: str = "is_rejected",
) -> DataFrame:
    """Amount statistics and rejection rate per group and overall, in one pass.

    ``rollup`` adds the whole-table row, so the claims are read once for both uses. Amounts
    that are NaN are left out.
    """
    return (
        claims.rollup(group)
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("claims"),
            F.avg(known(F.col(amount))).alias("amount_mean"),
            F.stddev_samp(known(F.col(amount))).alias("amount_std"),
            mean_of_flag(F.col(label)).alias("rejection_rate"),
        )
    )


def with_zscore(
    claims: DataFrame, baselines: DataFrame, amount: str = "billed_amount"
) -> DataFrame:
    """Amount z-score against the whole-table row of ``baselines`` (sample deviation).

    Null where the amount is null or NaN, or the deviation is 0 or undefined.
    """
    overall = baselines.filter(F.col("level") == _TOTAL_LEVEL).select(
        F.struct("amount_mean", "amount_std")
    ).scalar()
    return claims.withColumn(
        f"{amount}_zscore",
        F.try_divide(
            known(F.col(amount)) - overall.getField("amount_mean"), overall.getField("amount_std")
        ),
    )


def with_group_risk(
    claims: DataFrame,
    baselines: DataFrame,
    group: str = "provider_specialty",
    max_broadcast_rows: int = BROADCAST_ROWS,
    settled: bool = False,
) -> DataFrame:
    """Rejection rate of the claim's group; null for a null group.

    ``settled`` says that ``baselines`` is a stored table and need not be stored again.
    """
    rates = baselines.filter(
        (F.col("level") != _TOTAL_LEVEL) & F.col(group).isNotNull()
    ).select(group, F.col("rejection_rate").alias(f"{group}_risk"))
    return attach_lookup(claims, rates, [group], max_broadcast_rows, settled)


def with_baselines(claims: DataFrame, baselines: DataFrame | None = None) -> DataFrame:
    """Z-score and specialty risk. ``baselines`` may be a table stored by an earlier run."""
    if baselines is None:
        baselines = settle(claim_baselines(claims), "baselines")
    return with_group_risk(with_zscore(claims, baselines), baselines, settled=True)
