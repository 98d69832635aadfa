"""Approximate distinct counts from stored sketches that can be merged.

A sketch is a fixed number of bytes per group however many values it has seen (HyperLogLog with 2^14
registers: a standard error of 0.8 %), so sketches per day and group are kept beside the claims and
distinct counts of any time and grouping are unions of sketches, not passes over claims.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14


def distinct_sketches(
    claims: DataFrame, by: Sequence[str], columns: Sequence[str], lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``by`` with the count of ``rows`` and a sketch of each column. Nulls are not counted."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_registers)).alias(c) for c in columns]
    return claims.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merged_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups; ``by`` may be empty."""
    unions = [F.hll_union_agg(c).alias(c) for c in columns]
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), *unions)


def distinct_estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches' estimates in their places."""
    return sketches.withColumns({c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0)) for c in columns})
