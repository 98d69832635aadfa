"""Table verification and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def verify_tables(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per table: whether it exists and how many columns it has."""
    rows = []
    for name in names:
        exists = spark.catalog.tableExists(name)
        rows.append((name, exists, len(spark.table(name).columns) if exists else 0))
    return spark.createDataFrame(rows, "table_name string, table_exists boolean, columns int")


def profile_counts(frame: DataFrame, date_column: str | None = None) -> DataFrame:
    """Row count and, where the column is present, its first and last date."""
    measures = [F.count(F.lit(1)).alias("total_records")]
    if date_column in frame.columns:
        measures += [
            F.min(date_column).alias("earliest"),
            F.max(date_column).alias("latest"),
        ]
    return frame.agg(*measures)


def profile_columns(frame: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of each column.

    One pass over the table; the columns become rows afterwards.
    """
    names = frame.columns
    kinds = dict(frame.dtypes)
    row = frame.agg(*[F.count(c).alias(c) for c in names])
    counts = row.unpivot([], names, "column_name", "non_null")
    facts = F.create_map(
        *[
            x
            for i, c in enumerate(names)
            for x in (F.lit(c), F.struct(F.lit(i + 1).alias("position"), F.lit(kinds[c]).alias("kind")))
        ]
    )
    fact = F.element_at(facts, F.col("column_name"))
    return counts.select(
        fact.getField("position").alias("position"),
        "column_name",
        fact.getField("kind").alias("data_type"),
        "non_null",
    )


def sample_rows(frame: DataFrame, rows: int = 5) -> DataFrame:
    return frame.limit(rows)
