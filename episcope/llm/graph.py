"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _large(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least node around it."""
    around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are tied to the least of them (edges have u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, comp): the least node reachable from every node that has a link (a, b).

    Each round writes its edges to the shared folder; it ends when all edges
    are stars (no node is both below and above another), after a number of
    rounds that grows with the logarithm of the component size.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    for _ in range(rounds):
        chained = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        forked = edges.groupBy("u").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x != y")
        if not chained.take(1) and not forked.take(1):
            break
        edges = materialize(_small(_large(edges).distinct()).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
