"""Rule scorecards as Column expressions.

A scorecard is a base value and an ordered list of rules. Each rule has a predicate and
a delta; the deltas are added left to right, because later threshold tests depend on the
exact double that this order gives. Rules may carry a label and a recommended action.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def items_where(items: Sequence[tuple[Column, Column]]) -> Column:
    """Array of the texts whose test is true, in order.

    Built by ``concat``, which compiles, unlike the lambda behind ``array_compact``.
    """
    nothing = F.array().cast("array<string>")
    return F.concat(*[F.when(test, F.array(text)).otherwise(nothing) for test, text in items])


@dataclass(frozen=True)
class Rule:
    code: str
    test: Column
    delta: float = 0.0
    label: str | None = None
    label_detail: Column | None = None
    action: str | None = None

    def label_column(self, with_detail: bool = True) -> Column:
        if self.label_detail is None or not with_detail:
            return F.lit(self.label)
        return F.concat(F.lit(f"{self.label} ("), self.label_detail, F.lit(")"))


def _delta_if(test: Column, rule: Rule) -> Column:
    # ``if`` compiles to less code than a one-branch CASE; a null test gives 0.
    return F.call_function("if", test, F.lit(rule.delta), F.lit(0.0))


@dataclass(frozen=True)
class Scorecard:
    base: float
    rules: Sequence[Rule] = field(default_factory=tuple)
    low: float | None = None
    high: float | None = None

    def extended(self, *rules: Rule) -> Scorecard:
        """The same scorecard with further rules, for example one payor's own."""
        return replace(self, rules=(*self.rules, *rules))

    def flag_name(self, rule: Rule) -> str:
        return f"_rule_{rule.code}"

    def with_flags(self, frame: DataFrame) -> DataFrame:
        """Evaluate every predicate once, as boolean columns. Null counts as not fired."""
        return frame.withColumns(
            {self.flag_name(r): F.coalesce(r.test, F.lit(False)) for r in self.rules}
        )

    def without_flags(self, frame: DataFrame) -> DataFrame:
        return frame.drop(*[self.flag_name(r) for r in self.rules])

    def flag(self, rule: Rule) -> Column:
        return F.col(self.flag_name(rule))

    def _fold(self, tests: Sequence[Column]) -> Column:
        total = reduce(
            lambda acc, pair: acc + _delta_if(*pair),
            zip(tests, self.rules),
            F.lit(self.base),
        )
        if self.high is not None:
            total = F.least(F.lit(self.high), total)
        if self.low is not None:
            total = F.greatest(F.lit(self.low), total)
        return total

    def score(self) -> Column:
        """The score straight from the predicates."""
        return self._fold([r.test for r in self.rules])

    def score_from_flags(self) -> Column:
        """The score from the columns made by :meth:`with_flags`."""
        return self._fold([self.flag(r) for r in self.rules])

    def _labelled(self, with_detail: bool) -> list[Column]:
        return [
            F.when(self.flag(r), r.label_column(with_detail)) for r in self.rules if r.label
        ]

    def _actions(self) -> list[Column]:
        return [F.when(self.flag(r), F.lit(r.action)) for r in self.rules if r.action]

    def label_slots(self, with_detail: bool = True) -> Column:
        """One array slot per rule, null where the rule did not fire."""
        return F.array(*self._labelled(with_detail))

    def action_slots(self) -> Column:
        return F.array(*self._actions())

    def labels(self, with_detail: bool = True) -> Column:
        return items_where(
            [(self.flag(r), r.label_column(with_detail)) for r in self.rules if r.label]
        )

    def actions(self) -> Column:
        return items_where([(self.flag(r), F.lit(r.action)) for r in self.rules if r.action])

    def label_text(self, separator: str = "; ") -> Column:
        return F.concat_ws(separator, *self._labelled(True))

    def action_text(self, separator: str = "; ") -> Column:
        return F.concat_ws(separator, *self._actions())

    def any_label_mentions(self, word: str) -> Column:
        """True where a fired rule's label contains ``word``, ignoring case."""
        hits = [self.flag(r) for r in self.rules if r.label and word in r.label.lower()]
        return reduce(lambda a, b: a | b, hits, F.lit(False))
