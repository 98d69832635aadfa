"""Positions inside groups without a window over a group, so that a hot group is not one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import settle

_ROW_BITS = 33  # of monotonically_increasing_id: rows within a partition
# Rows that one window takes at most in ``prefix_sums``.
BLOCK = 1024


def numbered(frame: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``frame`` with the 0-based position ``name`` of each row in its group by ``order``.

    Rows are sorted into ranges of (group, order) and stored once; a row's position is its place in
    its range plus the group's rows in the ranges before. A group may cover many ranges. Positions
    are gapless; rows that tie in ``order`` get them in any order.
    """
    keys = [F.col(g).asc_nulls_first() for g in group]
    ranged = frame.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    stored = settle(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    placed = stored.withColumns(
        {
            "_part": F.shiftright("_id", _ROW_BITS),
            "_at": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    pieces = placed.groupBy(*group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per range that the group covers.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(offsets, same).select(
        *frame.columns, (F.col("_at") + F.col("_offset")).alias(name)
    )


def prefix_sums(
    frame: DataFrame, key: str, index: str, values: Sequence[str], most: int, block: int = BLOCK
) -> DataFrame:
    """``(key, index, sums)`` with the sums of ``values`` over the key's rows of smaller index.

    ``frame`` has one row per key and index, and no index above ``most``. Blocks of ``block``
    indices are summed first and their own prefix sums added, level by level, so that no window
    holds more than ``block`` rows however long a key is.
    """

    def before(*keys: str):
        window = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(v).over(window), F.lit(0)).alias(v) for v in values]

    if most < block:
        return frame.select(key, index, *before(key))
    blocks = frame.withColumn("_block", F.expr(f"{index} div {block}"))
    totals = blocks.groupBy(key, "_block").agg(*[F.sum(v).alias(v) for v in values])
    offsets = prefix_sums(totals, key, "_block", values, most // block, block).withColumnsRenamed(
        {v: f"_{v}" for v in values}
    )
    inside = blocks.select(key, index, "_block", *before(key, "_block"))
    return inside.join(offsets, [key, "_block"]).select(
        key, index, *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in values]
    )
