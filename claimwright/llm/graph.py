"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.session import settle


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).collect()[0]
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the component's least node.

    Alternating large-star and small-star steps: each node tells its neighbours the least node it
    knows, first those above it, then those below it. Every step is a combinable minimum per node
    and a join; the number of rounds grows with the logarithm of the longest path. Each round is a
    table in the shared folder, so lost executors cost one round at most.
    """
    stars = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stars = settle(stars.distinct(), "stars")
    before = _digest(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        large = settle(large, "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (
            joined.filter("b > m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        stars = settle(small, "stars")
        after = _digest(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
