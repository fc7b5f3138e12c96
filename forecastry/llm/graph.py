"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of longs to (node, root): the smallest node reachable.

    Large-star and small-star rounds: every round is two map-side-combined
    minima and two joins on the link table, whose hot centres AQE can split;
    its rows never grow beyond the links.  A round ends in a checkpoint, so a
    lost executor costs one round.  It stops when a round changes nothing, after
    about as many rounds as the logarithm of the longest chain.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    before = _state(edges)
    while True:
        # large star: neighbours above a node move to its least neighbour
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small star: a node and its lower neighbours move to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
