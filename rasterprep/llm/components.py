"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one neighbour below, which itself has none, or none (columns ``a``
    above ``b``, no edge twice)."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("below")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("below")))).alias("e"))
    met = ends.groupBy("e.node").agg(F.sum("e.below").alias("below"), F.min("e.below").alias("least"))
    # two below, or one below and one above
    return met.agg(F.expr("count_if(below > 1 OR (below = 1 AND least = 0))").alias("n")).first()["n"] == 0


def connected(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (columns ``a``, ``b``): the label is the
    smallest node of its component.

    Each round links every node's neighbours to the smallest of them, first the larger
    neighbours (large star), then the smaller (small star); minima are aggregated before
    the shuffle, so the centre of a large star is no hot key there, and a round's edges
    are a written table.  Edges that are stars need no round.  The number of rounds grows
    with the logarithm of the size.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = materialize(edges, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # edges that arise twice here are one after the small star
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(small.select("e.a", "e.b").where("a > b").distinct(), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
