"""Tables of batches that readers see whole or not at all.

Data files are written once, to folders of their own, and never replaced. What readers see is the latest
manifest, a small table that names each published batch's folder and rows. A new manifest is staged and
becomes visible by one rename to the next version, which fails if another writer took that version. A
failure before the rename leaves the batches as they were; folders that no manifest names are litter,
which ``sweep`` deletes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.session import discard
from claimwright.sources.schemas import conform

_MANIFEST = "batch string, folder string, rows long"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _children(spark: SparkSession, path: str) -> list[str]:
    files, folder = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _version(spark: SparkSession, path: str) -> int:
    """The latest manifest's version; 0 where nothing is published."""
    found = [n for n in _children(spark, f"{path}/_manifests") if n.startswith("v")]
    return max((int(n[1:]) for n in found), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``batch, folder, rows`` of what is published, by default in the latest version."""
    number = _version(spark, path) if version is None else version
    if not number:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"{path}/_manifests/v{number}")


def _replace(spark: SparkSession, path: str, rows: list[tuple], version: int) -> None:
    """Make ``rows`` the manifest after ``version`` by a rename; an error if there is one already."""
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(staged)
    target = f"{path}/_manifests/v{version + 1}"
    files, folder = _files(spark, target)
    files.mkdirs(folder.getParent())
    folder, origin = (files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(p)) for p in (target, staged))
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(origin, folder, never_over)
    except Py4JJavaError as refused:
        discard(spark, staged)
        raise RuntimeError(f"version {version + 1} of {path} is not published") from refused


def publish(frame: DataFrame, path: str, batch: str, table: str | None = None) -> int:
    """Publish ``frame`` as ``batch``, in the place of an earlier one of this name; the number of its rows.

    An empty batch is refused. The rows are written once; their number comes from the files' footers.
    """
    spark, path = frame.sparkSession, path.rstrip("/")
    folder = f"_data/{uuid.uuid4().hex}"
    (conform(frame, table) if table else frame).write.parquet(f"{path}/{folder}")
    rows = spark.read.parquet(f"{path}/{folder}").count()
    if not rows:
        discard(spark, f"{path}/{folder}")
        raise ValueError(f"batch {batch} is empty")
    version = _version(spark, path)
    others = [tuple(r) for r in manifest(spark, path, version).filter(F.col("batch") != batch).collect()]
    _replace(spark, path, [*others, (batch, folder, rows)], version)
    return rows


def withdraw(spark: SparkSession, path: str, batch: str) -> bool:
    """Take a batch out of the table; False if it is not published."""
    version = _version(spark, path)
    found = [tuple(r) for r in manifest(spark, path, version).collect()]
    kept = [r for r in found if r[0] != batch]
    if len(kept) < len(found):
        _replace(spark, path, kept, version)
    return len(kept) < len(found)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published rows with their ``batch``; a reader keeps to the version it began with."""
    path = path.rstrip("/")
    found = manifest(spark, path, version).collect()
    if not found:
        raise FileNotFoundError(f"nothing is published in {path}")
    frames = [
        spark.read.parquet(f"{path}/{r.folder}").withColumn("batch", F.lit(r.batch)) for r in found
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def sweep(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete manifests but the last ``keep``, and the data folders that none of these names; how many folders.

    Only while no batch is being written.
    """
    path, latest = path.rstrip("/"), _version(spark, path.rstrip("/"))
    named: set[str] = set()
    for number in range(1, latest + 1):
        if number > latest - keep:
            named |= {r.folder for r in manifest(spark, path, number).collect()}
        else:
            discard(spark, f"{path}/_manifests/v{number}")
    discard(spark, f"{path}/_staged")
    litter = [n for n in _children(spark, f"{path}/_data") if f"_data/{n}" not in named]
    for name in litter:
        discard(spark, f"{path}/_data/{name}")
    return len(litter)


def copy_ranges(
    source: DataFrame, path: str, key: str, bounds: Sequence, table: str | None = None, most: int | None = None
) -> list[str]:
    """Copy ``source`` in ranges of ``key`` that ``bounds`` separate; the ranges copied by this call.

    ``most`` is how many ranges this call may copy, for a copy that is spread over several runs.

    Each range is a batch of its own, named by its lower bound. Ranges that are already published are
    not read again, so a copy that failed goes on after the last one; null keys are in the first range.
    """
    spark = source.sparkSession
    done = {r.batch for r in manifest(spark, path.rstrip("/")).collect()}
    edges = [None, *bounds, None]
    copied = []
    for low, high in zip(edges, edges[1:]):
        name = f"{key}>={low}" if low is not None else f"{key} first"
        if name in done:
            continue
        if most is not None and len(copied) == most:
            break
        part = source
        if low is not None:
            part = part.filter(F.col(key) >= F.lit(low))
        if high is not None:
            below = F.col(key) < F.lit(high)
            part = part.filter(below if low is not None else below | F.col(key).isNull())
        try:
            publish(part, path, name, table)
        except ValueError:
            continue  # no rows in this range
        copied.append(name)
    return copied
