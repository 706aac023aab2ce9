"""Connected components of an edge table by alternating star contractions, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import stored


def least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = least_neighbour(both).select(F.col("u").alias("of"), F.least("u", "least").alias("least"))
    joined = both.filter("v > u").join(least, F.col("u") == F.col("of"))
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = least_neighbour(edges).select(F.col("u").alias("of"), "least")
    joined = edges.join(least, F.col("u") == F.col("of"))
    tied = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select(F.col("of").alias("u"), F.col("least").alias("v")))
    return tied.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: for every node with an edge (a, b), the least node it is connected to. Only a count and a
    checksum of the edges reach the driver; the rounds end when they no longer change."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(after) == before or not after[0]:
            break
        before = tuple(after)
        edges = stored(small_star(large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
