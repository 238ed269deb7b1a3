"""Connected components by alternating star contraction.

Every round turns the links into stars around ever smaller members with two
grouped minima and two joins. The links of a round are a written table, so a
lost executor costs one round at most, and nothing is held by the driver but a
count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Links each greater neighbour of a node to the least of its neighbourhood."""
    both = links.unionAll(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select(F.col("high").alias("node"), F.least("high", "least").alias("least"))
    # links seen from their smaller end: node = low, neighbour = high
    return (
        links.join(least, links.low == least.node)
        .select(F.col("high"), F.col("least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links each smaller neighbour of a node, and the node, to the least of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select(F.col("high").alias("node"), "least")
    moved = links.join(least, links.high == least.node).filter("low > least")
    return (
        least.select(F.col("node").alias("high"), F.col("least").alias("low"))
        .unionAll(moved.select(F.col("low").alias("high"), F.col("least").alias("low")))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("checksum"),
    ).first()
    return row.n, row.checksum


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable from each linked node.

    Nodes are non-null longs. Repeated links, links in both directions and links
    of a node to itself are allowed; a node with no other link has no row, and an
    empty table gives an empty one.
    """
    pairs = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    current = written(pairs.filter("high > low").distinct(), "links")
    state = _state(current)
    while state[0]:
        current = written(_small_star(_large_star(current)), "links")
        before, state = state, _state(current)
        if state == before:
            break
    leaves = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    centres = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return leaves.unionAll(centres)
