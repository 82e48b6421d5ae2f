"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.session import durable


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node``, ``root`` for every node of an edge; the root is the smallest node reachable.

    Large stars tie a node's larger neighbours to its smallest one, small stars its
    smaller neighbours; after some rounds (the log of the longest chain, in practice)
    every node hangs on its root. Only minima per node are aggregated, never lists of
    neighbours, so a node with very many edges is no burden. Loops and repeated edges
    are allowed; null ends are left out.
    """
    whole = edges.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    nodes = whole.select(F.least(left, right).alias("low"), F.greatest(left, right).alias("high"))
    state = durable(nodes.where(F.col("low") != F.col("high")).distinct())
    loops = nodes.select(F.explode(F.array("low", "high")).alias("node")).distinct()
    while not _hung(state):
        state = durable(_small_star(_large_star(state)))
    hung = state.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    return loops.join(hung, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _hung(edges: DataFrame) -> bool:
    """Whether every node hangs on its root: no node has two smaller neighbours, or one as well as larger ones."""
    ends = edges.select(F.explode(F.array(*[F.struct(F.col(end).alias("node"), F.lit(n).alias("up")) for end, n in (("high", 1), ("low", 0))])).alias("e"))
    counted = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n"))
    return counted.where((F.col("up") > 0) & (F.col("n") > 1)).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("low").alias("n"), F.col("high").alias("m")).union(edges.select("high", "low"))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
    larger = both.where(F.col("m") > F.col("n"))
    # Repeated edges are left to the small star behind it.
    return larger.join(least, "n").select(F.col("least").alias("low"), F.col("m").alias("high"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(least, "high")
    moved = joined.select(F.col("least").alias("low"), F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("high"))
    return moved.where(F.col("low") != F.col("high")).distinct()
