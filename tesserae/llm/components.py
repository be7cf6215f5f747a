"""Connected components by alternating large-star and small-star rounds, each written to the shared folder.

Both stars take the minimum of a node's neighbours with a map-side combine and join it back, so a node with very many
neighbours is never gathered into one task; the joins are left to adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame) -> DataFrame:
    """edges (a > b): every larger neighbour and the node itself point to the smallest of them."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    small = large.join(low, F.col("a") == F.col("k")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.*").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of one orderable type -> (node, component) of every node that has an edge to another; component is the
    smallest node reachable. Loops, repeats and nulls in edges are ignored."""
    edges = edges.toDF("a", "b").where("a <> b")
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        edges = materialize(_star(edges))
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())
