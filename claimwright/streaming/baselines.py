"""Baselines that grow with a stream: mergeable moments in a table of versions.

A version holds, per group, the count, exact total and sum of squared deviations of the amount and the
counts of the label. Batch n merges its own moments into version n - 1 and writes version n, so a batch that
runs again after a failure writes the same version again. Each batch is scored with the version before
it, by which time nothing of the batch itself is in its baselines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimwright.functions import known
from claimwright.operators.statistics import with_group_risk, with_zscore
from claimwright.session import discard

_MOMENTS = ["claims", "n", "total", "squares", "labelled", "flagged"]
# Totals are whole 10^-4 units, so they do not depend on the order of rows or batches.
_UNITS = 10_000.0
_TOTAL = "decimal(38,0)"


def _mean(total: str, n: str) -> Column:
    return F.coalesce(F.try_divide(F.col(total).cast("double") / _UNITS, F.col(n).cast("double")), F.lit(0.0))


def moments(claims: DataFrame, group: str = "provider_specialty", amount: str = "billed_amount", label: str = "is_rejected") -> DataFrame:
    """One row per group, null being a group: what is needed to merge counts, means, deviations and rates."""
    value = known(F.col(amount)).cast("double")
    return claims.groupBy(F.col(group).alias("group")).agg(
        F.count(F.lit(1)).alias("claims"),
        F.count(value).alias("n"),
        F.coalesce(F.sum(F.floor(value * _UNITS + 0.5).cast("decimal(18,0)")), F.lit(0)).cast(_TOTAL).alias("total"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("squares"),
        F.count(label).alias("labelled"),
        F.count_if(F.col(label)).alias("flagged"),
    )


def merged(one: DataFrame, two: DataFrame) -> DataFrame:
    """The moments of the rows of both; each has one row per group."""
    a = one.select("group", *[F.col(c).alias(f"a_{c}") for c in _MOMENTS])
    b = two.select(F.col("group").alias("b_group"), *[F.col(c).alias(f"b_{c}") for c in _MOMENTS], F.lit(True).alias("_in_b"))
    both = a.join(b, F.col("group").eqNullSafe(F.col("b_group")), "full").select(
        F.when(F.col("_in_b"), F.col("b_group")).otherwise(F.col("group")).alias("group"),
        *[F.coalesce(f"{side}_{c}", F.lit(0)).alias(f"{side}_{c}") for side in "ab" for c in _MOMENTS],
    )
    n = F.col("a_n") + F.col("b_n")
    part = F.coalesce(F.try_divide(F.col("b_n").cast("double"), n.cast("double")), F.lit(0.0))
    step = _mean("b_total", "b_n") - _mean("a_total", "a_n")
    return both.select(
        "group",
        *[(F.col(f"a_{c}") + F.col(f"b_{c}")).alias(c) for c in ("claims", "labelled", "flagged")],
        n.alias("n"),
        (F.col("a_total") + F.col("b_total")).cast(_TOTAL).alias("total"),
        (F.col("a_squares") + F.col("b_squares") + step * step * F.col("a_n") * part).alias("squares"),
    ).select("group", *_MOMENTS)


def baselines(state: DataFrame, group: str = "provider_specialty") -> DataFrame:
    """Moments as the rows of ``claim_baselines``: one per group, and one for all claims."""

    def row(level: int, name):
        return (
            name.alias(group),
            F.lit(level).cast("tinyint").alias("level"),
            "claims",
            F.when(F.col("n") > 0, _mean("total", "n")).alias("amount_mean"),
            F.sqrt(F.try_divide(F.col("squares"), F.when(F.col("n") > 1, F.col("n") - 1))).alias("amount_std"),
            F.try_divide(F.col("flagged").cast("double"), F.col("labelled").cast("double")).alias("rejection_rate"),
        )

    sums = state.agg(F.sum("total").cast(_TOTAL).alias("total"), F.sum("n").alias("n"))
    off = _mean("total", "n") - sums.select(_mean("total", "n")).scalar()
    total = state.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("claims", "n", "labelled", "flagged")],
        F.coalesce(F.sum("total"), F.lit(0)).cast(_TOTAL).alias("total"),
        F.sum(F.col("squares") + F.col("n") * off * off).alias("squares"),
    )
    kind = state.schema["group"].dataType
    return state.select(*row(0, F.col("group"))).unionByName(total.select(*row(1, F.lit(None).cast(kind))))


def _version(store: str, number: int) -> str:
    return f"{store.rstrip('/')}/version={number}"


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the whole versions, ascending: those whose job has committed."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    folders = [f.getPath() for f in files.listStatus(root) if f.getPath().getName().startswith("version=")]
    done = [f for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().partition("=")[2]) for f in done)


def stored_moments(spark: SparkSession, store: str, before: int | None = None) -> DataFrame | None:
    """The latest version, or the latest below ``before``; None where there is none."""
    found = [v for v in versions(spark, store) if before is None or v < before]
    return spark.read.parquet(_version(store, found[-1])) if found else None


def running_baselines(
    claims: DataFrame,
    store: str,
    target: str,
    checkpoint: str,
    group: str = "provider_specialty",
    amount: str = "billed_amount",
    label: str = "is_rejected",
    keep: int = 3,
    available_now: bool = False,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Score each batch with the baselines of all batches before it, then add the batch to them.

    Scored batches go to ``target``/batch=n, versions of the moments to ``store``/version=n, of which the
    last ``keep`` stay. Claims of the first batch have null scores. The store is a table of groups, so a
    batch reads the claims once for both uses.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            earlier = stored_moments(spark, store, before=number)
            own = moments(kept, group, amount, label)
            if earlier is None:
                scored = kept.withColumns({f"{amount}_zscore": F.lit(None).cast("double"), f"{group}_risk": F.lit(None).cast("double")})
            else:
                table = baselines(earlier, group)
                scored = with_group_risk(with_zscore(kept, table, amount), table, group, settled=True)
            scored.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")
            state = own if earlier is None else merged(earlier, own)
            state.write.mode("overwrite").parquet(_version(store, number))
        finally:
            kept.unpersist()
        for old in versions(spark, store)[: -max(2, keep)]:  # a repeated batch still needs the one before
            discard(spark, _version(store, old))

    writer = claims.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()
