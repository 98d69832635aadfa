"""The registered queries of this subpackage and their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("q_warc", "q_suffixes", "q_language", "q_mixing", "q_decontaminate", "q_simhash", "q_secrets", "q_toxicity", "q_token_counts", "q_quality", "q_collocations", "q_prefix_trie", "q_sharding")

Query = Callable[[SparkSession, str], DataFrame]


def _entries() -> dict[str, tuple[Query, str | None]]:
    found: dict[str, tuple[Query, str | None]] = {}
    for module in _MODULES:
        found.update(import_module(f"claimwright.llm.{module}").QUERIES)
    return found


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
