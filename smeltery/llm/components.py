"""Connected components by alternating stars, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    pairs = _both_ways(links)
    low = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    hung = pairs.where(F.col("b") > F.col("a")).join(low, "a")
    return hung.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = pairs.groupBy("a").agg(F.min("b").alias("low"))
    hung = pairs.join(low, "a").where(F.col("b") != F.col("low"))
    moved = hung.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: columns ``node``, ``root``.

    ``links`` has two columns, ``a`` and ``b``, of one orderable type; direction, repeats and loops
    don't matter. Roots themselves, nodes without links and an empty table give no rows. Each round
    is written to the shared folder, so that neither lineage nor a lost executor makes a later
    round repeat an earlier one. A node with very many links is a hot join key; adaptive execution
    splits it, and the grouped side is one row per node.
    """
    now = stored(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    state = _state(now)
    while state[0]:
        after = stored(_small_star(_large_star(now)), "links")
        reached = _state(after)
        now = after
        if reached == state:
            break
        state = reached
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
