"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import written


def _large_star(pairs: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    lower = pairs.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    ends = pairs.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node that links reach) of every node with a link
    to a smaller one; a node not listed is its own component.

    Large-star and small-star steps alternate until only stars are left, a logarithmic number of
    rounds. Each round is written to the shared folder, so that a lost executor costs one round.
    Null ends and links from a node to itself mean nothing.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    pairs = ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        pairs = written(_small_star(_large_star(pairs)), "components")
        if _are_stars(pairs):
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
