"""Mixing sources to target weights as a time-varying curriculum.

A source's share of the training run is its target: the words of all sources, shared by weight, but
at most ``MOST`` times the source's own words, with the excess shared again by weight. The targets
are the water level at which all shares add up, found from running sums over the sources in the order
in which they reach their limits.

Within its target a source is spent along a schedule: its rate moves linearly from one multiple of
its mean to another over the run. Documents of a source stand in an order drawn from a hash of their
ids and are read over and over until the target is met. The demand up to training position t is the
integral of the schedule; inverting it at the middle of each reading gives the reading's position,
and sorting by position mixes the sources as their schedules ask.

Running sums are taken in two steps, over 4,096 hash buckets of a source and inside a bucket, so a
source with a third of all rows is spread over many tasks.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the
last one; documents with a null id stand first, equal ids are told apart by size and text. Repeated
rows are documents of their own. An empty table gives an empty result. Further columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
# Rate at the start and at the end of the run, as multiples of the mean, per weight in turn.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
_BUCKET_DIGITS = 3


def text_size(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, place, target`` from ``source, source_size``, one row per source."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") + 1)
    placed = (
        sizes.withColumn("place", ((F.row_number().over(named) - 1) % len(weights)).cast("int"))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
    )
    reached = Window.orderBy((F.col("limit") / F.col("weight")), F.col("source").asc_nulls_last())
    before = reached.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    open_ = (
        placed.withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / F.col("share"))
        .withColumn("at", F.row_number().over(reached))
    )
    # The first source that does not reach its limit sets the level for itself and all later ones.
    free = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("at", "level"))
    return open_.withColumn("level", F.min(free).over(whole)["level"]).select(
        "source",
        "source_size",
        "place",
        F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def position_of(used: Column, start: Column, end: Column) -> Column:
    """The time at which a share ``used`` of the target is spent at a rate from start to end.

    Solves used = start * t + (end - start) / 2 * t^2 for mean rate 1, in the form without
    cancellation.
    """
    return 2 * used / (start + F.sqrt(start * start + 2 * (end - start) * used))


def plan(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    most: int = MOST,
    schedules: tuple = SCHEDULES,
) -> DataFrame:
    """Every document as struct ``row`` with size, target, ``taken`` words and reading positions.

    The struct holds all columns but the text.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in docs.columns if n != "text"]).alias("row"),
        F.col("source").alias("source"),
        F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256).alias("draw"),
        text_size(F.col("text")).alias("size"),
        F.xxhash64("text").alias("tie"),
    ).withColumn("bucket", F.substring("draw", 1, _BUCKET_DIGITS))
    rows = settle(rows, "sizes")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    per_source = Window.partitionBy("source")
    earlier = per_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = settle(
        buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))),
        "buckets",
    )
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = settle(source_targets(sizes, weights, most), "targets")
    starts = buckets.join(
        targets.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))
    ).select(
        F.struct("source", "bucket").alias("key"), "bucket_start", "source_size", "place", "target"
    )
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("draw", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn(
        "key", F.struct("source", "bucket")
    )
    placed = placed.join(starts, "key").withColumn("_start", F.col("bucket_start") + F.col("_inside"))
    rates = F.element_at(
        F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in schedules]),
        F.col("place") % len(schedules) + 1,
    )
    # Twice the middle of reading e, against twice the target: whole numbers on the left.
    middles = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(most - 1)),
            lambda e: 2 * (e * F.col("source_size") + F.col("_start")) + F.col("size"),
        ),
        lambda twice: (F.col("size") > 0) & (twice <= 2 * F.col("target")),
    )
    return (
        placed.withColumn("_rates", rates)
        .withColumn("_middles", middles)
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (F.size("_middles") * F.col("size")).cast("long").alias("taken"),
            F.transform(
                "_middles",
                lambda twice: position_of(twice / (2 * F.col("target")), F.col("_rates.a"), F.col("_rates.b")),
            ).alias("positions"),
        )
    )


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """One row per reading of a document, range-sorted by training position, without the texts."""
    planned = plan(docs, **settings)
    return planned.select(
        "row.*", "size", "target", F.posexplode("positions").alias("reading", "position")
    ).orderBy("position", "reading")


def readings(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, one row per reading, range-sorted by ``position``.

    Columns of the documents with ``reading`` and ``position``; columns of those names are replaced.
    The plan is made without the texts, which move twice: to their readings and to their positions.
    Wholly equal rows are told apart by a running number on both sides.
    """
    names = [n for n in docs.columns if n not in ("reading", "position")]
    identity = F.struct(
        F.col("doc_id").alias("id"), F.xxhash64(*[F.col(f"`{n}`") for n in docs.columns]).alias("row")
    )
    planned = plan(docs.select("doc_id", "source", "text", identity.alias("identity")), **settings)
    planned = planned.select(F.col("row.identity").alias("key"), "positions").withColumn(
        "copy", F.row_number().over(Window.partitionBy("key").orderBy("positions"))
    )
    rows = docs.select(identity.alias("key"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1))))
    taken = planned.filter(F.size("positions") > 0)
    return (
        rows.join(taken, ["key", "copy"])
        .select("row.*", F.posexplode("positions").alias("reading", "position"))
        .orderBy("position", "reading")
    )
