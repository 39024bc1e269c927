"""Connected components by alternating large-star and small-star, as joins and aggregates.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). No group is ever gathered: the smallest
neighbour of a node is an aggregate with partial sums, and its edges meet it again in a join whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, join_split


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where(F.col("b") > F.col("a"))
    return join_split(larger, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_split(edges, least, ["a"]).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def _flat(edges: DataFrame) -> bool:
    """Whether every node that points to another does so once, and to one that points to none: the edges are stars."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    return nodes.where("ups > 1 or (ups = 1 and n > 1)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links`` (a, b): the smallest node that can be reached.

    Self-links, repeated links and links with a null end count for nothing (a node that has only those is not
    returned). Empty links give an empty table. Every round is written to shared storage, so lost executors cost one
    round at most; rounds grow with the logarithm of the longest path. A result may be given again among the links of a
    later call (id, component), which then takes no round for what it held already.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a is not null and b is not null and a <> b")
    edges = cut(edges.select(larger.alias("a"), smaller.alias("b")).distinct(), "links")
    while not _flat(edges):
        edges = cut(_small_star(cut(_large_star(edges), "large-star")), "small-star")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
