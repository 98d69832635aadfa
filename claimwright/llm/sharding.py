"""Shards of equal bytes by a k-d tree over the metadata.

The table is split recursively. Each cell is cut along its widest dimension, the one whose range in
the cell is the largest part of its range in the table (ties: the first one named), at the weighted
median: the place where the bytes on both sides are in proportion to the shards they are to become.
A cell that is to be one shard is a leaf.

Medians are found for all cells of a level together. Rows are summed into bins of each cell's
current interval; the bin that holds the median becomes the next interval, until a bin's edge is
near enough. A round returns one row per cell to the driver; cells are at most ``MAX_SHARDS``.
Rows that agree on the dimension are ordered by a hash of the text, then of the id, then by a number
of their own, so that any hot value or group of copies can be cut. Equal texts take the smallest
coordinates of their group, so they lie side by side, and a cut goes to the nearer end of a group
unless that would move more than 1/100 of a shard's bytes. Slots are numbered over sorted ranges.

Coordinates are numbers: strings count by their first six bytes in UTF-8, dates by days, times by
seconds, booleans as 0 and 1.

Defined cases: a null text has no bytes; every document has one byte more than its text, so empty
ones are spread too. A null or NaN coordinate counts as -1, infinite ones as +-1e150. Repeated rows
are documents of their own. With fewer documents than shards some shards stay empty. An empty table
gives an empty result. Further columns are ignored by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.numbering import numbered
from claimwright.session import discard, settle

DIMENSIONS = ("source", "lang", "n_chars")
# Shards are bounded, as a round's medians, one row per cell, are on the driver.
MAX_SHARDS = 100_000
# A cut may miss its median by these parts of a shard's bytes: anywhere, and to keep copies together.
NEAR, TOGETHER = 1 / 1000, 1 / 100
# Bins of one round over all cells.
BINS = 1 << 16
_KEYS = ["k0", "k1", "k2", "k3"]
_LEAST, _MOST = -1e308, 1e308


def coordinate(name: str, kind: T.DataType) -> Column:
    """The column as a number that keeps its order."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        number = F.conv(head, 16, 10).cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, T.TimestampNTZType):
        number = value.cast("timestamp").cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        number = value.cast("double")
    else:
        raise ValueError(f"{name} of type {kind.simpleString()} is no dimension")
    bounded = F.greatest(F.lit(-1e150), F.least(F.lit(1e150), number))
    return F.when(number.isNull() | F.isnan(number), -1.0).otherwise(bounded)


def _rank(value: Column) -> Column:
    """52 bits of a hash, exact as a double."""
    return F.shiftrightunsigned(F.xxhash64(value), 12).cast("double")


def _weighed(docs: DataFrame, dimensions: Sequence[str], carry: Sequence[Column]) -> DataFrame:
    """A narrow row per document: carried columns, size, dimensions and the three orders of ties."""
    kinds = {f.name: f.dataType for f in docs.schema}
    text = F.col("text").cast("string")
    axes = [coordinate(n, kinds[n]).alias(f"c{i}") for i, n in enumerate(dimensions)]
    rows = settle(
        docs.select(
            *carry,
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            *axes,
            _rank(text).alias("k1"),
            _rank(F.col("doc_id")).alias("k2"),
            F.monotonically_increasing_id().cast("double").alias("k3"),
        ),
        "weighed",
    )
    # Equal texts share the smallest coordinates of their group.
    names = [f"c{i}" for i in range(len(axes))]
    groups = rows.groupBy("k1").agg(
        F.count(F.lit(1)).alias("_copies"), *[F.min(c).alias(f"_{c}") for c in names]
    )
    shared = groups.filter("_copies > 1").drop("_copies")
    return rows.join(shared, "k1", "left").withColumns(
        {c: F.coalesce(f"_{c}", c) for c in names}
    ).drop(*[f"_{c}" for c in names])


@dataclass
class _Cut:
    """The search for one cell's weighted median. ``fixed`` are the keys resolved so far."""

    node: int
    shards: int
    axis: int
    goal: float
    low: float
    high: float
    before: float = 0.0
    fixed: list[float] = field(default_factory=list)
    key: list[float] | None = None

    def narrow(self, found, shard_bytes: float) -> None:
        """Take the bin that holds the median: cut at one of its ends, or look inside it."""
        stage = len(self.fixed)
        low, high = found[f"low{stage}"], found[f"high{stage}"]
        left, right = self.goal - found["until"], found["until"] + found["bytes"] - self.goal
        single = low == high
        near = shard_bytes * (TOGETHER if single and stage == 1 else NEAR)  # at stage 1: one group of copies
        if min(left, right) <= near or (single and stage == 3):
            edge = low if left <= right else high
            fill = _LEAST if left <= right else _MOST
            key = [*self.fixed, edge]
            self.key = [*key, *[fill] * (len(_KEYS) - len(key))]
        elif single:
            self.fixed.append(low)
            self.low, self.high = found[f"low{stage + 1}"], found[f"high{stage + 1}"]
            self.before = found["until"]
        else:
            self.low, self.high, self.before = low, high, found["until"]


_SEARCH = "_node int, _axis int, _stage int, _fixed array<double>, _low double, _high double, _before double, _goal double, _bins long"


def _step(rows: DataFrame, cuts: list[_Cut], axes: int) -> list:
    """For each cell, the bin of its interval that holds the median."""
    # Bins are a column and no constant, so that every round runs the same compiled code.
    bins = max(16, BINS // len(cuts))
    state = rows.sparkSession.createDataFrame(
        [(c.node, c.axis, len(c.fixed), c.fixed, c.low, c.high, c.before, c.goal, bins) for c in cuts], _SEARCH
    )
    keyed = rows.join(F.broadcast(state), rows["node"] == state["_node"]).withColumn("k0", _axis(axes))
    keys = F.array(*_KEYS)
    at = F.get(keys, F.col("_stage"))
    inside = (F.slice(keys, F.lit(1), F.col("_stage")) == F.col("_fixed")) & at.between(F.col("_low"), F.col("_high"))
    width = F.col("_high") - F.col("_low")
    bin_of = F.when(width > 0, F.least(F.col("_bins") - 1, F.floor((at - F.col("_low")) / width * F.col("_bins")))).otherwise(0)
    edges = [f(k).alias(f"{n}{i}") for i, k in enumerate(_KEYS) for f, n in ((F.min, "low"), (F.max, "high"))]
    cells = (
        keyed.filter(inside)
        .groupBy("node", bin_of.alias("bin"))
        .agg(F.sum("size").alias("bytes"), F.first("_before").alias("_before"), F.first("_goal").alias("_goal"), *edges)
    )
    upto = Window.partitionBy("node").orderBy("bin")
    summed = cells.withColumn("until", F.col("_before") + F.sum("bytes").over(upto) - F.col("bytes"))
    kept = ["until", "bytes", *[f"{n}{i}" for i in range(len(_KEYS)) for n in ("low", "high")]]
    holds = summed.filter(F.col("until") <= F.col("_goal")).groupBy("node").agg(
        F.max_by(F.struct(*kept), "bin").alias("found")
    )
    return holds.select("node", "found.*").collect()


def _drop(stored: DataFrame) -> None:
    """Delete a table of an earlier level."""
    for folder in {unquote(f).rpartition("/")[0] for f in stored.inputFiles()}:
        discard(stored.sparkSession, folder)


def _axis(axes: int) -> Column:
    return F.get(F.array(*[F.col(f"c{i}") for i in range(axes)]), F.col("_axis"))


def _ranges(rows: DataFrame, axes: int) -> list:
    aggregates = [f(f"c{i}").alias(f"{n}{i}") for i in range(axes) for f, n in ((F.min, "low"), (F.max, "high"))]
    return rows.groupBy("node").agg(F.sum("size").alias("bytes"), *aggregates).collect()


def _widest(cell, extent: list[float], axes: int) -> int:
    parts = [(cell[f"high{i}"] - cell[f"low{i}"]) / extent[i] if extent[i] else 0.0 for i in range(axes)]
    return parts.index(max(parts))


def _split(rows: DataFrame, shards: int, axes: int) -> DataFrame:
    """``rows`` with their shard in ``node``; each level's table replaces the one before."""
    rows = settle(rows.withColumn("node", F.lit(0)), "cells")
    cells, extent, shard_bytes = {0: shards}, None, 0.0
    while any(n > 1 for n in cells.values()):
        open_cells = [node for node, n in cells.items() if n > 1]
        found = {r["node"]: r for r in _ranges(rows, axes)}
        if extent is None:
            if not found:
                return rows
            extent = [found[0][f"high{i}"] - found[0][f"low{i}"] for i in range(axes)]
            shard_bytes = found[0]["bytes"] / shards
        cuts = []
        for node in open_cells:
            if node in found:
                axis = _widest(found[node], extent, axes)
                goal = found[node]["bytes"] * (cells[node] // 2) / cells[node]
                cuts.append(
                    _Cut(node, cells[node], axis, goal, found[node][f"low{axis}"], found[node][f"high{axis}"])
                )
        searching = cuts
        while searching:
            by_node = {r["node"]: r for r in _step(rows, searching, axes)}
            for cut in searching:
                cut.narrow(by_node[cut.node], shard_bytes)
            searching = [c for c in searching if c.key is None]
        placed = rows.sparkSession.createDataFrame(
            [(c.node, c.axis, c.shards // 2, *c.key) for c in cuts],
            "_node int, _axis int, _left int, _k0 double, _k1 double, _k2 double, _k3 double",
        )
        key = F.struct(_axis(axes).alias("a"), F.col("k1").alias("b"), F.col("k2").alias("c"), F.col("k3").alias("d"))
        edge = F.struct(*[F.col(f"_k{i}").alias(n) for i, n in enumerate("abcd")])
        side = F.when(F.col("_node").isNotNull() & (key > edge), F.col("node") + F.col("_left")).otherwise(F.col("node"))
        joined = rows.join(F.broadcast(placed), rows["node"] == placed["_node"], "left")
        earlier, rows = rows, settle(joined.select(*[c for c in rows.columns if c != "node"], side.alias("node")), "cells")
        _drop(earlier)
        cells = {
            first: n
            for node, n0 in cells.items()
            for first, n in (((node, n0 // 2), (node + n0 // 2, n0 - n0 // 2)) if n0 > 1 else ((node, n0),))
        }
    return rows


def assign(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = DIMENSIONS,
    carry: Sequence[Column] | None = None,
) -> DataFrame:
    """``size, text_crc32, shard, slot`` per document, beside the carried columns (default ``doc_id``).

    Give the number of ``shards`` or the ``target_bytes`` that a shard is to reach. Slots count from
    0 in each shard, in the order of the hash of the text, then of the id.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    if not dimensions:
        raise ValueError("at least one dimension is needed")
    carried = [F.col("doc_id")] if carry is None else list(carry)
    names = docs.select(*carried).columns
    rows = _weighed(docs, dimensions, carried)
    if shards is None:
        total = rows.agg(F.sum("size")).collect()[0][0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"{shards} shards; 1 to {MAX_SHARDS} are possible")
    cells = _split(rows, shards, len(dimensions))
    placed = cells.select(*names, "size", "text_crc32", "k1", "k2", "k3", F.col("node").alias("shard"))
    order = [F.col(k).asc() for k in ("k1", "k2", "k3")]
    return numbered(placed, ["shard"], order, "slot").drop("k1", "k2", "k3")


def write_shards(
    docs: DataFrame,
    path: str,
    target_bytes: int,
    dimensions: Sequence[str] = DIMENSIONS,
    file_rows: int = 100_000,
) -> DataFrame:
    """Write the documents with all their columns to ``path`` in a folder ``shard=n`` each.

    Rows of a shard are written in files of ``file_rows`` slots, so a shard is no single task's
    work. Returns ``shard, documents, bytes``.
    """
    clash = {"shard", "slot", "_row"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the writer's own")
    stored = settle(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered-documents")
    placed = settle(
        assign(stored, target_bytes=target_bytes, dimensions=dimensions, carry=[F.col("_row")]), "placed"
    )
    joined = stored.join(placed.select("_row", "shard", "slot"), "_row").drop("_row")
    file_of = F.floor(F.col("slot") / file_rows)
    ranged = joined.repartitionByRange("shard", file_of, "slot").sortWithinPartitions("shard", "slot")
    ranged.write.mode("errorifexists").option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
    return placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("size").alias("bytes")
    )
