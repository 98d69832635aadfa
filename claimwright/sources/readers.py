"""Reading claims and applications from files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.sources.schemas import reader_schema

# Columns of the public applications file.
PUBLIC_APPLICATIONS = (
    "age INT, sex STRING, bmi DOUBLE, children INT, smoker STRING, region STRING, charges DOUBLE"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a given schema, NaN as null. A missing path raises."""
    return nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


def read_training_csv(
    spark: SparkSession, path: str, fill: bool = True, labels: Sequence[str] = ("rejection_reason",)
) -> DataFrame:
    """Labelled training claims: dates parsed, nulls filled except in ``labels``."""
    text_dates = reader_schema("bpo_claims_training").replace("TIMESTAMP", "STRING")
    frame = parse_dates(read_csv(spark, path, text_dates), ["service_date", "submission_date"])
    return fill_missing(frame, keep=labels) if fill else frame


def parse_dates(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parse the given date columns that are present; unreadable text becomes null."""
    return frame.withColumns(
        {c: F.try_to_timestamp(c).cast("timestamp_ntz") for c in columns if c in frame.columns}
    )


def fill_missing(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nulls become 0, '0' or false by type; columns in ``keep`` stay as they are."""
    kinds = {
        c.name: c.dataType for c in frame.schema.fields if c.name not in keep
    }
    numbers = [n for n, k in kinds.items() if isinstance(k, T.NumericType)]
    texts = [n for n, k in kinds.items() if isinstance(k, T.StringType)]
    flags = [n for n, k in kinds.items() if isinstance(k, T.BooleanType)]
    for value, columns in ((0, numbers), ("0", texts), (False, flags)):
        if columns:
            frame = frame.fillna(value, columns)
    return frame


def read_applications(
    spark: SparkSession, path: str, fallback: DataFrame | None = None
) -> DataFrame:
    """Public applications file, or ``fallback`` where it is absent or empty."""
    from pyspark.errors import AnalysisException

    try:
        frame = read_csv(spark, path, PUBLIC_APPLICATIONS)
        empty = frame.isEmpty()
    except AnalysisException:
        empty = True
    if not empty:
        return frame
    if fallback is None:
        raise ValueError(f"no applications at {path} and no fallback given")
    return fallback


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Partitioned scan of a database table over a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, **options)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def nan_to_null(frame: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes null."""
    floats = [
        c.name for c in frame.schema.fields if isinstance(c.dataType, (T.FloatType, T.DoubleType))
    ]
    return frame.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
