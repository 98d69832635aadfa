"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("screening", "decisions", "processing", "quality", "learning", "history", "streams", "gaps", "loading", "event_time", "networks")

Query = Callable[[SparkSession, str], DataFrame]


def _entries() -> dict[str, tuple[Query, str | None]]:
    found: dict[str, tuple[Query, str | None]] = {}
    for module in _MODULES:
        for name, entry in import_module(f"claimwright.plans.{module}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
