"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import drop_stored, stored


def large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Join every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``, stored, for every node of ``edges(a long, b long)``; the component is its smallest node.

    Alternates the two star operations until nothing changes. No step gathers
    the neighbours of a node: each is an aggregate with partial sums and a join
    that splits skewed keys. Every round is written to the shared folder.
    """
    current, before = stored(edges.where("a <> b").select("a", "b").distinct(), "edges"), None
    while True:
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            found = current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
            found = stored(found, "components")
            drop_stored(current)
            return found
        before, old = state, current
        current = stored(small_star(large_star(current)).distinct(), "edges")
        drop_stored(old)
