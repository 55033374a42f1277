"""Connected components of a table of links, by alternating stars.

Each round links every node's neighbours to the smallest one around it, first the larger neighbours,
then the smaller ones, until each component is a star round its smallest node. Rounds grow with the
logarithm of the longest chain. Every round is a written table in the shared folder, so a lost
executor costs one round at most; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.staging import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links come as (larger, smaller)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each linked node: columns node, root.

    `links` has two columns of one ordered type. Nodes without a link are not in the result.
    """
    first, second = links.columns
    known = links.select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
    ).where(F.col("a") != F.col("b"))
    current = stage(known.distinct(), "links")
    state = None
    while True:
        current = stage(_small_star(_large_star(current)), "links")
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
