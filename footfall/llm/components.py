"""Connected components of an edge table, by rounds of joins.

Each round points every node's larger neighbours, then its smaller ones, at its smallest
neighbour, until nothing changes: the stars of Kiveris et al. (2014). Only minima are taken,
so a node with very many neighbours is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(node, least) over (node, other) pairs, the node itself included."""
    return pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b), root being its component's smallest."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        # Larger neighbours point at the smallest one.
        pairs = _both_ways(edges)
        large = pairs.where("other > node").join(_least_neighbour(pairs), "node")
        large = staged(large.select(F.col("other").alias("node"), F.col("least").alias("other")).where("node <> other").distinct(), "large")
        # Then a node's smaller neighbours, and the node itself, do.
        least = _least_neighbour(large)
        small = large.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
        edges = staged(small.where("a <> b").distinct(), "small")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
