"""Connected components of an edge table by alternating stars.

Each round links every neighbour above a node to the lowest node of its neighbourhood (large star), then every
neighbour below it likewise (small star), until the edges are stars: each then points at the lowest node of
its component. Rounds grow with the logarithm of the size. The lowest neighbour is a minimum that combines in
the map tasks, and it is joined back, so a node with very many neighbours is a join key that Spark can split.
Each round is written to the shared folder and its predecessor removed; a lost executor repeats part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinproof.llm.tables import clean_shuffles, dropped, written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).select("a", F.least("a", "low").alias("low"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.withColumnRenamed("low", "b")).where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """True if the edges are stars: no node has two edges down, or one down and one up."""
    one = lambda node, down: F.struct(F.col(node).alias("node"), F.lit(down).alias("down"), F.lit(1 - down).alias("up"))
    ends = edges.select(F.inline(F.array(one("a", 1), one("b", 0))))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    with clean_shuffles(edges.sparkSession):
        return not nodes.agg(F.max(F.expr("down > 1 OR down = 1 AND up = 1"))).first()[0]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of all nodes but the lone ones; ``root`` is the lowest node of the component.

    Edges have no direction; NULL ends and loops are left out, repeated edges count once.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y")
    now = written(both.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    while not _settled(now):
        before, now = now, written(_small_star(_large_star(now)), "edges")
        dropped(before)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
