"""Connected components of a distributed edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.words import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both).select("u", F.least("m", "u").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = _smallest(edges)
    joined = edges.join(low, "u").select("u", "v", "m")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of `links` (columns u, v, any order); root is the smallest node reachable.

    Nodes without a link are not listed. A round writes its edges to the scratch folder, so
    lineage stays short; the number of rounds grows with the logarithm of the largest component.
    """
    edges = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), label)
        # Both steps leave a forest of stars unchanged; the sums tell any other change.
        now = edges.agg(
            F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not now[0] or now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = now
