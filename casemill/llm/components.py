"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest one, itself included."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of these. Edges are (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for the nodes of edges (a, b) that aren't roots themselves.

    Edges may be given in any direction and repeatedly; loops don't count. No edges give no rows. The steps
    run until the edge list stays the same; only its size and checksum reach the driver. A node with
    many neighbours is met by partial minima and by joins that Spark splits.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    total = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = total(now)
    while True:
        now = materialize(_small(_large(now)), "edges")
        after = total(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
