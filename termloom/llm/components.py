"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.staging import Stage
from termloom.operators.joins import same_value


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest_neighbour(both).withColumn("m", F.least("of", "m"))
    joined = both.join(least, same_value(F.col("u"), F.col("of"))).where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = _smallest_neighbour(edges)
    joined = edges.join(least, same_value(F.col("u"), F.col("of"))).where("v > m")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("of").alias("u"), F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is its smallest node.

    Large-star and small-star steps in turn, about as many as the logarithm of the longest
    path. Every step is a table in the shared folder, so a lost executor costs one step; a hot
    node's edges are partially aggregated and its join partition can be split. The driver sees
    two numbers a step. Edges with a null end and loops are ignored.
    """
    start = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    now, before = Stage(start.distinct()), None
    while True:
        digest = now.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest == before or not digest[0]:
            break
        before = digest
        following = Stage(_small_star(_large_star(now.df)))
        now.drop()
        now = following
    roots = now.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
