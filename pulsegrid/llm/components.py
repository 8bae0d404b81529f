"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a long, b long); root is the smallest node of its component.

    Each round hangs larger neighbours (large star), then smaller ones (small star), on the smallest
    neighbour of a node. Only minima and joins are used, so a node with very many links needs no task of
    its own; Spark splits the join of a hot node. Rounds grow with the logarithm of the longest path, and
    each is written to the shared folder. Links with a null end and loops are ignored; no links give no rows.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")
        )
        edges = written(small.select("e.*").where("a <> b").distinct(), "stars")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
