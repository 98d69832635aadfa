"""Session settings, shared scratch space and size-checked lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lookups up to this many rows are broadcast; larger ones take the salted shuffle join.
BROADCAST_ROWS = 100_000
JOIN_SALTS = 32
# Methods of more bytecode than this are not compiled by the JVM, only interpreted.
JIT_BYTES = 8_000
# A key with more rows than this is salted; 10^12 rows hold at most 10^5 such keys.
HOT_ROWS = 10_000_000
# Paths that each session has settled.
_settled: WeakKeyDictionary[SparkSession, list[str]] = WeakKeyDictionary()


def build_session(
    app_name: str = "claimwright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Session with adaptive execution, skew handling and UTC timestamps.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Wide scorecards: fall back to per-operator code rather than methods the JIT skips.
        .config("spark.sql.codegen.hugeMethodLimit", str(JIT_BYTES))
        # No call-site capture per column expression: scorecards build thousands of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_methods_small(spark: SparkSession) -> None:
    """Let wide projections fall back to code per operator in a session that others have built, too.

    Spark's own limit is 64 KB, but the JVM interprets methods of more than 8,000 bytes: a scorecard that
    is fused with a join into one such method takes several times as long for each row.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > JIT_BYTES:
        spark.conf.set(name, str(JIT_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="claimwright-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, name: str = "settled") -> DataFrame:
    """Compute ``frame`` once into a table in the shared folder and read it back.

    The result has no lineage to recompute, and its size is known to the optimizer.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    _settled.setdefault(spark, []).append(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table's files, on whatever store they are."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard_settled(spark: SparkSession) -> int:
    """Delete all tables that ``settle`` has written in this session; how many there were.

    For services and long sessions, once the results that read them have been written.
    """
    paths = _settled.pop(spark, [])
    for path in paths:
        discard(spark, path)
    return len(paths)


def attach_lookup(
    frame: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    settled: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Left-join ``lookup`` (one row per key) onto ``frame``, a stream or a table.

    The lookup is computed once and counted. A small one is broadcast, so ``frame`` is not
    shuffled; a large one is joined by a shuffle in which adaptive execution splits the hot
    keys of ``frame``. Pass ``settled`` for a lookup that is already a stored table, and
    ``null_safe`` if a null key is to find the lookup's null key.
    """
    frozen = lookup if settled else settle(lookup, "lookup")
    if frozen.limit(max_rows + 1).count() <= max_rows:
        frozen = F.broadcast(frozen)
    if null_safe:
        return null_safe_left_join(frame, frozen, keys)
    return frame.join(frozen, list(keys), "left")


def unbroadcast(frame: DataFrame) -> DataFrame:
    """``frame`` for a join of two sides that both grow with the input: it is shuffled and sorted, whatever its size.

    Spark would broadcast what it takes for small, but it sizes a table by its compressed files, and an
    exploded one by the rows before the explode.
    """
    return frame.hint("merge")


def null_safe_left_join(frame: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys are equal to each other."""
    names = {key: f"_key_{i}" for i, key in enumerate(keys)}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return frame.join(other.withColumnsRenamed(names), same, "left").drop(*names.values())


def salted_left_join(
    frame: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salts: int = JOIN_SALTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of two large sides in which only hot keys are salted.

    Keys with more than ``hot_rows`` rows are found by a count that is combined on the map
    side. Their rows, and rows with a null key, go to up to ``salts`` tasks, and only their
    lookup rows are repeated. There are at most rows / ``hot_rows`` such keys.

    The salt depends on row content and input partition only, so a retried task
    reproduces it, and identical rows from different partitions still spread out.
    """
    keys = list(keys)
    hot = settle(
        frame.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*keys, F.lit(True).alias("_hot")),
        "hot-keys",
    )
    few = hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hot = F.broadcast(hot) if few else hot
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.pmod(F.xxhash64(*frame.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    marked = frame.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | any_null, spread).otherwise(F.lit(0))
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = lookup.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    return (
        marked.drop("_hot").join(repeated.drop("_hot"), [*keys, "_salt"], "left").drop("_salt")
    )
