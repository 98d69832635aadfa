"""Column helpers shared by the operators."""

from claimwright.functions.numeric import (
    exact_mean,
    exact_sum,
    half_up,
    known,
    mean_of_flag,
    ratio_or_zero,
    share,
)
from claimwright.functions.inputs import Inputs
from claimwright.functions.scorecard import Rule, Scorecard, items_where

__all__ = [
    "Inputs",
    "Rule",
    "Scorecard",
    "exact_mean",
    "exact_sum",
    "half_up",
    "items_where",
    "known",
    "mean_of_flag",
    "ratio_or_zero",
    "share",
]
