"""Joins on the latest earlier row, without a window over a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import settle


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    span: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """``left`` with the ``values`` of each row's latest row of ``right`` at or before it.

    Both sides are put together and the last right row is carried forward in the order of time. A key is
    cut into time ranges, given by ``span`` of the common time ``_time`` (default: its calendar month), so
    a window holds one key's rows of one range however hot the key is; the last right row of each range
    is carried over into later ones by a window over one row per key and range.

    ``strict`` leaves out right rows of the same time. Null keys are equal to each other. Left rows
    without a time, and those before any right row, get nulls; right rows without a time match nothing.
    Of right rows with equal key and time the one with the greatest values counts, nulls being smallest.
    """
    clash = {"_time", "_side", "_span", "_found", "_row"} & {*left.columns, *right.columns}
    taken = (set(values) & set(left.columns)) | clash
    if taken:
        raise ValueError(f"columns {sorted(taken)} are on both sides or the join's own")
    keys = list(keys)
    found = F.struct(*[F.col(v) for v in values])
    figures = (
        right.filter(F.col(right_time).isNotNull())
        .groupBy(*keys, F.col(right_time).cast("timestamp").alias("_time"))
        .agg(F.max(found).alias("_found"))
    )
    # Rows of one time: right ones come first, or last if they may not match it.
    theirs = figures.select(*keys, "_time", F.lit(1 if strict else 0).alias("_side"), "_found", F.lit(None).cast(_struct(left)).alias("_row"))
    ours = left.select(
        *keys,
        F.col(left_time).cast("timestamp").alias("_time"),
        F.lit(0 if strict else 1).alias("_side"),
        F.lit(None).cast(theirs.schema["_found"].dataType).alias("_found"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"),
    )
    part = F.trunc(F.col("_time").cast("date"), "month") if span is None else span
    # Stored, as both the carried values and the rows are read from it.
    both = settle(ours.unionByName(theirs).withColumn("_span", part), "asof")
    last = (
        both.filter(F.col("_found").isNotNull())
        .groupBy(*keys, "_span")
        .agg(F.max_by("_found", "_time").alias("_last"))
    )
    spans = both.select(*keys, "_span").distinct()
    ranges = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate([*keys, "_span"])]
    renamed = last.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate([*keys, "_span"])})
    carried = (
        spans.join(renamed, same, "left")
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(ranges))
        .select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate([*keys, "_span"])], "_carried")
    )
    inside = Window.partitionBy(*keys, "_span").orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_own", F.last("_found", ignorenulls=True).over(inside)).filter(F.col("_row").isNotNull())
    joined = rows.join(carried, same, "left")
    match = F.when(F.col("_time").isNotNull(), F.coalesce("_own", "_carried"))
    return joined.withColumn("_match", match).select(
        *[F.col("_row").getField(c).alias(c) for c in left.columns],
        *[F.col("_match").getField(v).alias(v) for v in values],
    )


def _struct(frame: DataFrame):
    return frame.schema
