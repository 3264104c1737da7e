"""Connected components of a graph of edges, by turning every component into a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import saved


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter("a != b").distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lowest, "a")
    down = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node with an edge; the root is the least node of its component.

    The number of rounds grows with the logarithm of the size of a component.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = saved(pairs.filter("a != b").distinct())
    mark = None
    while True:
        print_ = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if print_ == mark or not print_["n"]:
            break
        mark = print_
        now = saved(_stars(now))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
