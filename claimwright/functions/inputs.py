"""Reading rule inputs from a frame whose optional columns may be missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Inputs:
    """Typed access to rule inputs.

    A default applies only when the column is absent. A null, NaN or non-numeric value
    in a present column reads as null, which makes every comparison on it not fire.
    """

    def __init__(self, frame: DataFrame):
        self._types = {field.name: field.dataType for field in frame.schema.fields}

    def has(self, name: str) -> bool:
        return name in self._types

    def _plain_number(self, name: str, default: float | None) -> Column:
        if not self.has(name):
            return F.lit(default).cast("double")
        if isinstance(self._types[name], T.StringType):
            return F.col(name).try_cast("double")
        return F.col(name)

    def _may_be_nan(self, name: str) -> bool:
        kinds = (T.StringType, T.FloatType, T.DoubleType)
        return isinstance(self._types.get(name), kinds)

    def number(self, name: str, default: float | None = None) -> Column:
        value = self._plain_number(name, default)
        return F.when(~F.isnan(value), value) if self._may_be_nan(name) else value

    def above(self, name: str, threshold: float, default: float | None = None) -> Column:
        """``number > threshold``. Spark sorts NaN above every number, so NaN is excluded."""
        value = self._plain_number(name, default)
        if self._may_be_nan(name):
            return (value > threshold) & ~F.isnan(value)
        return value > threshold

    def below(self, name: str, threshold: float, default: float | None = None) -> Column:
        """``number < threshold``, which is false for NaN as it stands."""
        return self._plain_number(name, default) < threshold

    def text(self, name: str, default: str | None = None) -> Column:
        return F.col(name) if self.has(name) else F.lit(default)

    def flag(self, name: str, default: bool) -> Column:
        if not self.has(name):
            return F.lit(default)
        if isinstance(self._types[name], T.BooleanType):
            return F.col(name)
        return F.col(name).try_cast("boolean")

    def unreadable_number(self, name: str) -> Column:
        """True where text stands in a numeric column."""
        if not isinstance(self._types.get(name), T.StringType):
            return F.lit(False)
        return F.col(name).isNotNull() & F.col(name).try_cast("double").isNull()

    def null_in(self, name: str) -> Column:
        return F.col(name).isNull() if self.has(name) else F.lit(False)
