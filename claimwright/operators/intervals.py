"""Joins on time ranges: by bucketed time with an exact check, and as counts without pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import settle


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    bucket_seconds: int,
) -> DataFrame:
    """Pairs of a point and a range [``start``, ``end``) of the same key that holds its ``time``.

    A range is repeated for each bucket of time that it touches, a point is in one, so the join is by
    key and bucket, with the exact bounds checked after it, and a hot key is spread over its buckets.
    Choose buckets about as long as the usual range. Null keys are equal to each other; null times and
    bounds match nothing; empty ranges hold nothing. Columns on both sides other than keys are an error.
    """
    clash = (set(points.columns) & set(ranges.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides")
    width = bucket_seconds * 1_000_000
    first, last = F.floor(_micros(start) / width), F.floor((_micros(end) - 1) / width)
    listed = (
        ranges.filter(F.col(start) < F.col(end))
        .withColumn("_bucket", F.explode(F.sequence(first, last)))
        .withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
    )
    placed = points.filter(F.col(time).isNotNull()).withColumn("_at", F.floor(_micros(time) / width))
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    inside = (F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))
    joined = placed.join(listed, [F.col("_at") == F.col("_bucket"), *same]).filter(inside)
    return joined.drop("_at", "_bucket", *[f"_key{i}" for i in range(len(keys))])


def overlap_counts(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    name: str = "overlaps",
    span: Column | None = None,
) -> DataFrame:
    """``left`` with the number of ranges of ``right`` of the same key that overlap its own [start, end).

    No pairs are formed: the ranges that overlap are those that start before the end, less those that end
    at or before the start. Both are running counts over the times of a key, which is cut into spans of
    time (default: calendar months); counts run inside a span from what the spans before it add up to, which
    a row at its beginning carries, so no task sees a whole key. Pass the same frame as ``left`` and ``right``
    for ranges among themselves: it is then computed once. Empty or undefined ranges overlap nothing; null keys are equal.
    """
    clash = {"_time", "_span", "_row", "_one", "_two", "_sign", "_order", name} & {*left.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the join's own")
    keys = list(keys)
    rows = settle(left.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    others = rows if right is left else settle(right.select(*keys, start, end), "others")
    real = F.col(start) < F.col(end)

    def events(frame: DataFrame, time: str, order: int, one: Column, row: Column, sign: int) -> DataFrame:
        return frame.filter(real).select(
            *keys,
            F.col(time).cast("timestamp").alias("_time"),
            F.lit(order).alias("_order"),
            one.cast("long").alias("_one"),
            row.cast("long").alias("_row"),
            F.lit(sign).alias("_sign"),
        )

    none, probe = F.lit(None), F.col("_row")
    # At one time: ends first, then the question how many have ended, then how many have started, then starts.
    counted = [
        events(others.select(*keys, start, end), end, 0, F.lit(1), none, -1),
        events(rows, start, 1, F.lit(0), probe, -1),
        events(rows, end, 2, F.lit(0), probe, 1),
        events(others.select(*keys, start, end), start, 3, F.lit(1), none, 1),
    ]
    both = counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])
    part = F.trunc(F.col("_time").cast("date"), "month") if span is None else span
    # Not stored: four narrow readings of stored ranges are less than what they would write.
    both = both.withColumn("_span", part)
    by = [*keys, "_sign"]
    totals = both.groupBy(*by, "_span").agg(F.sum("_one").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_n", F.sum("_n").over(earlier)).filter("_n <> 0")
    # A null time comes first, so what is carried counts for the whole span.
    firsts = carried.select(
        *keys,
        F.lit(None).cast("timestamp").alias("_time"),
        F.lit(-1).alias("_order"),
        F.col("_n").alias("_one"),
        F.lit(None).cast("long").alias("_row"),
        "_sign",
        "_span",
    )
    # Starts count before the time, ends up to it: both by the order of the events at one time.
    inside = Window.partitionBy(*by, "_span").orderBy("_time", "_order").rangeBetween(Window.unboundedPreceding, 0)
    asked = both.unionByName(firsts).withColumn("_here", F.sum("_one").over(inside)).filter(F.col("_row").isNotNull())
    answers = asked.groupBy("_row").agg(F.sum(F.col("_sign") * F.col("_here")).alias(name))
    found = rows.join(answers, "_row", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return found.drop("_row")
