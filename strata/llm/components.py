"""Connected components of a table of links, by spreading least labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, store


def connected_components(links: DataFrame) -> DataFrame:
    """(class, component) of every end of the links (a, b); component: the least class reachable.

    Each round hangs every node under the least node among its neighbours and
    itself (large star), then under the least of its smaller neighbours (small
    star), until no link changes; labels and links stay distributed, each round
    is stored. Both stars aggregate before they shuffle, so a node with very
    many links is reduced in every task first. An empty table gives an empty
    result.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
                  "cc-links")
    last = None
    while True:
        # Large star: every larger neighbour of a node is linked to the node's least neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        # Small star: every smaller neighbour and the node itself are linked to the least of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v") \
            .unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        before, edges = edges, store(small, "cc-round")
        discard(before)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("class"), "component")
    roots = edges.select(F.col("v").alias("class"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)
