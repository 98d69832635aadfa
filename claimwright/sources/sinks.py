"""Writing, appending and copying tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.sources.published import publish
from claimwright.sources.schemas import conform

JDBC_BATCH = 500
# Rows of a reconciled table per task, and the tasks that the copies of one key are dealt over first.
TASK_KEYS = 250_000
KEY_SALTS = 32


def write_csv(frame: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """CSV files with a header; Spark's readers tell a ``compression`` (gzip: at level 5) by the files' names."""
    writer = frame.write.mode(mode).option("header", True).option("zlib.compress.level", "FIVE")
    writer.csv(path, compression=compression)


def write_table(
    frame: DataFrame, path: str, date_column: str | None = "service_date", mode: str = "append"
) -> None:
    """Parquet files by month of ``date_column``, so that date filters skip folders.

    The rebalance hint gathers each month into few files and lets adaptive execution split
    a month that is far larger than the others.
    """
    if date_column is None or date_column not in frame.columns:
        frame.write.mode(mode).parquet(path)
        return
    dated = frame.withColumn("service_month", F.date_format(date_column, "yyyy-MM"))
    dated.hint("rebalance", "service_month").write.mode(mode).partitionBy("service_month").parquet(
        path
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All batches as one frame by column name; a column a batch lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def append_rows(frame: DataFrame, path: str, table: str | None = None) -> bool:
    """Append a batch to a parquet table; False, and no write, for an empty batch.

    The files of a batch become visible only when its job commits.
    """
    if frame.isEmpty():
        return False
    (conform(frame, table) if table else frame).write.mode("append").parquet(path)
    return True


def append_batch(frame: DataFrame, path: str, batch: str, table: str | None = None) -> int:
    """Publish a batch of the table in ``path``; the number of its rows.

    All or nothing: see ``published``, whose ``read_published`` reads the table. A batch that is loaded
    again takes the place of the earlier one, and an empty batch is refused.
    """
    return publish(frame, path, batch, table)


def append_jdbc(frame: DataFrame, url: str, table: str, **options: str) -> bool:
    """Append to a database table in batches; False for an empty batch."""
    if frame.isEmpty():
        return False
    (
        frame.write.format("jdbc")
        .mode("append")
        .options(url=url, dbtable=table, **options)
        .option("batchsize", JDBC_BATCH)
        .save()
    )
    return True


def copy_table(source: DataFrame, path: str, table: str | None = None) -> DataFrame:
    """Write ``source`` to ``path``, conformed to ``table`` if given, and read it back."""
    (conform(source, table) if table else source).write.mode("append").parquet(path)
    return source.sparkSession.read.parquet(path)


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of both sides, keys found on one side only, and whether all agree.

    One pass over each side, and one count for both. A key's rows are counted in up to ``KEY_SALTS`` tasks
    before they are brought together, so a key with very many copies does not wait for one task. Both
    shuffles have a number of partitions that grows with the target, a stored table whose rows the files'
    footers tell: adaptive execution would put as many keys into a task as compress well.
    """
    keys = list(keys)
    spark = source.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(target.count() / TASK_KEYS))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = source.select(*keys, one.alias("n"), none.alias("m")).unionByName(
        target.select(*keys, none.alias("n"), one.alias("m"))
    )
    counts = [F.sum("n").alias("n"), F.sum("m").alias("m")]
    salted = sides.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(KEY_SALTS)))
    near = salted.repartition(tasks, *keys, "_salt").groupBy(*keys, "_salt").agg(*counts).drop("_salt")
    both = near.repartition(tasks, *keys).groupBy(keys).agg(*counts)
    totals = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("target_rows"),
        F.count_if(F.col("m") == 0).alias("missing_keys"),
        F.count_if(F.col("n") == 0).alias("extra_keys"),
        F.count_if(F.col("n") != F.col("m")).alias("differing_keys"),
    )
    return totals.withColumn(
        "matches",
        (F.col("source_rows") == F.col("target_rows")) & (F.col("differing_keys") == 0),
    )
