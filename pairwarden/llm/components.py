"""Connected components of a link table, by alternating large-star and small-star rounds.

Rounds read and write tables in the shared folder; links are never collected. A node's
links are only aggregated (its smallest neighbour) and joined, so a node with very many
links is pre-aggregated and its join partitions can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each neighbour on the far (near) side of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    # staged, so that the join's sides are plain shuffles, of which a hub's partition can be split
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least")
    linked = both.join(least, "a")
    if large:
        moved = linked.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
    return moved.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link: root is the smallest node that is reachable.

    ``edges`` holds (a, b) of type long in any direction; loops and repeats do no harm.
    """
    edges = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        "links",
    )
    mark = None
    while True:
        edges = stage(_star(stage(_star(edges, True), "links"), False), "links")
        # unchanged links have an unchanged fingerprint
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).head()
        if now == mark or now[0] == 0:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
