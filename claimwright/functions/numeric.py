"""Rounding and order-independent aggregation of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, places: int) -> Column:
    """Round in plain double arithmetic, halves toward +infinity."""
    scale = F.lit(float(10**places))
    return F.floor(value * scale + F.lit(0.5)) / scale


def known(value: Column) -> Column:
    """NaN becomes null, as in the aggregates of data frames."""
    return F.when(~F.isnan(value.cast("double")), value)


def exact_sum(value: Column, places: int = 4) -> Column:
    """Sum as whole 10^-places units, so the result does not depend on row order.

    NaN is left out like null.

    The units are added as DECIMAL: a BIGINT total of money at four places would
    overflow near 10^11 claims.
    """
    units = F.floor(known(value) * F.lit(float(10**places)) + F.lit(0.5)).cast("decimal(18,0)")
    return F.sum(units).cast("double") / F.lit(float(10**places))


def exact_mean(value: Column, places: int = 4) -> Column:
    """Order-independent mean over the values that are numbers; null when there are none."""
    return F.try_divide(exact_sum(value, places), F.count(known(value)).cast("double"))


def mean_of_flag(flag: Column) -> Column:
    """Share of true among the non-null values; null when there are none."""
    return F.try_divide(F.count_if(flag).cast("double"), F.count(flag).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, or 0 where the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def ratio_or_zero(value: Column) -> Column:
    """Null becomes 0."""
    return F.coalesce(value, F.lit(0.0))
