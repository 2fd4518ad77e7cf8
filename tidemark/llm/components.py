"""Connected components of a link table, by alternating large-star and small-star.

Links live in DataFrames only. A star's centre is found by a plain minimum and
joined back, so a node with very many links is pre-aggregated and its rows can
be split over tasks. Each half-round is cut by a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def _settled(edges: DataFrame) -> bool:
    """Whether every node points at one root and no root points anywhere."""
    one = edges.groupBy("a").agg(F.min("b").alias("p"), F.max("b").alias("q"))
    crossed = one.filter("p <> q").select("a").unionAll(edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a"))
    return crossed.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    ``links`` has two columns of the same whole-number type; loops and repeated
    links do no harm. No link: an empty table.
    """
    a, b = links.columns
    edges = checkpointed(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    while not _settled(edges):
        # Large star: every larger neighbour moves to the least of its node's neighbourhood.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        edges = checkpointed(edges)
        # Small star: every smaller neighbour, and the node, move to the least of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a")
        edges = checkpointed(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
