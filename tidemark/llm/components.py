"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import released, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie each node's larger (or smaller) neighbours to the smallest of its neighbourhood; edges are (a, b), a > b.

    The smallest is an aggregate joined back, so a node with a third of all edges is split like any skewed join.
    """
    around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = around.join(least, "a")
    out = tied.where("b > a") if large else tied.unionByName(least.withColumn("b", F.col("a")).select("a", "b", "m"))
    return out.where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest node reachable) of every node with an edge to another; edges have no direction.

    Rounds of large and small stars end in one star per component, after about as many rounds as the logarithm of the
    longest chain: when every node hangs on one other, and on none that hangs itself. Each round is written; edges with a
    null end and loops count for nothing.
    """
    oriented = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = stored(oriented, "edges")
    while True:
        hanging = now.groupBy("a").agg(F.count("*").alias("n"))
        middle = now.select("b").join(hanging.select(F.col("a").alias("b")), "b", "left_semi")
        if hanging.where("n > 1").isEmpty() and middle.isEmpty():
            leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        now = stored(_stars(stored(_stars(now, large=True), "stars"), large=False), "edges")
        released(now.sparkSession)
