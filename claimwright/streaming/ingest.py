"""Continuous ingest of claims and applications with Structured Streaming.

The row operators (validation, screening, decisions) are plain columns, so they are applied
to a streaming frame as they are. Only whole-batch statistics need ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from claimwright.operators import applications, quality
from claimwright.operators.statistics import claim_baselines, with_group_risk, with_zscore
from claimwright.sources.schemas import conform


def file_stream(
    spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, optionally those whose name matches."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stored table as a stream, whether it is one file or a folder of part files."""
    table = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = table.inputFiles()
    if len(files) == 1 and unquote(files[0]).rpartition("/")[2] == name:
        return file_stream(spark, folder, table.schema, name, files_per_batch)
    return file_stream(spark, path, table.schema, None, files_per_batch)


def append_stream(
    stream: DataFrame, target: str, checkpoint: str, available_now: bool = False, every: str = "30 seconds"
) -> StreamingQuery:
    """Append a stream to a parquet table exactly once.

    ``available_now`` processes what is there and stops; otherwise a batch starts ``every``
    so often. A restart with the same checkpoint goes on where the last one stopped.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def ingest_claims(claims: DataFrame, target: str, checkpoint: str, table: str | None = None, **how) -> StreamingQuery:
    """Validate claims and append those that pass."""
    valid = quality.validate_claims(claims)
    return append_stream(conform(valid, table) if table else valid, target, checkpoint, **how)


def ingest_applications(
    raw: DataFrame, target: str, checkpoint: str, as_of: datetime | None = None, **how
) -> StreamingQuery:
    """Fill in absent columns and append without validation."""
    numeric = applications.normalize_categories(applications.to_numbers(raw))
    return append_stream(applications.backfill(numeric, as_of), target, checkpoint, **how)


def each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Apply ``work`` to every micro-batch and write its result to the batch's own folder.

    A batch that is run again after a failure overwrites its folder, so nothing is doubled.
    The batch is kept while it is worked on, so its source and joins are read once.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            work(kept).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")
        finally:
            kept.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def ingest_counted(
    claims: DataFrame,
    target: str,
    counts: str,
    checkpoint: str,
    rules: dict[str, Column] | None = None,
    available_now: bool = False,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Append the claims that pass all rules, and per batch how many each rule has removed.

    Kept rows go to ``target``/batch=n and one row of counts to ``counts``/batch=n. The counts are
    observed while the rows are written, so a batch is read once; a batch that is run again replaces
    both.
    """
    tests = quality.claim_rules() if rules is None else rules

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        observed = batch.observe(seen, *quality.removal_measures(tests))
        kept = observed.filter(quality.passes(tests))
        kept.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")
        found = {name: int(n) for name, n in seen.get.items()}
        found["removed_rows"] = found["initial_rows"] - found["kept_rows"]
        row = batch.sparkSession.createDataFrame([tuple(found.values())], [f"{n}" for n in found])
        row.write.mode("overwrite").parquet(f"{counts.rstrip('/')}/batch={number}")

    writer = claims.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def batch_statistics(claims: DataFrame, target: str, checkpoint: str, **how) -> StreamingQuery:
    """Z-score and specialty risk computed within each micro-batch.

    For statistics over all claims, pass a stored table to ``with_baselines`` instead and
    append the stream directly.
    """
    return each_batch(claims, _with_own_baselines, target, checkpoint, **how)


def _with_own_baselines(batch: DataFrame) -> DataFrame:
    """Baselines of the kept batch itself, without a stored table that would stay behind."""
    baselines = claim_baselines(batch)
    return with_group_risk(with_zscore(batch, baselines), baselines, settled=True)
