"""Connected components by alternating large-star and small-star rounds; edges stay distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.llm._shared import Scratch

#: A hub's edges are dealt over so many tasks.
SALTS = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """The edges (u, v), each with m, the smallest v of its u. A hub's edges are brought together by parts, never in one task."""
    edges = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = edges.groupBy("u", "salt").agg(F.min("v").alias("m"))
    told = parts.select("u", "salt").join(parts.groupBy("u").agg(F.min("m").alias("m")), "u")
    return edges.join(told, ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # the edge to the smallest one stays; of the others the far ends get one to it
    return _with_least(edges).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(u, v): each node but a component's smallest, with that smallest one. edges: (u, v) in either order."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    while True:
        before, edges = edges, scratch.table(_small_star(_large_star(edges)))
        scratch.drop(before)
        # done when every node has one edge and no smallest node has a smaller neighbour
        once = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        inner = edges.select(F.col("v").alias("u")).distinct().join(once.select("u"), "u", "left_semi")
        if once.where("n > 1").select("u").unionByName(inner).isEmpty():
            return edges
