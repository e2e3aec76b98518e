"""Connected components by alternating stars; nodes of very many edges are told to every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


#: Edges of a node that one task may hold, at least, and how many nodes may have more.
HOT, HOT_NODES = 100_000, 1000


def _with_lowest(edges: DataFrame, lowest: DataFrame, limit: int) -> DataFrame:
    """``a, b, low``: edges with the smallest number beside their ``a``; ``lowest`` counts edges as ``n``.

    The few nodes of more than ``limit`` edges go to every task, so their edges stay where they are.
    """
    hot = F.broadcast(lowest.where(F.col("n") > limit).select("a", F.col("low").alias("hot_low")))
    told = edges.join(hot, "a", "left")
    usual = told.where("hot_low IS NULL").drop("hot_low").join(lowest.select("a", "low"), "a")
    return usual.select("a", "b", "low").union(told.where("hot_low IS NOT NULL").select("a", "b", F.col("hot_low").alias("low")))


def components(edges: DataFrame, hot_edges: int = HOT) -> DataFrame:
    """``node, root`` for each node of edges ``a, b``: the root is the component's smallest node.

    Roots are listed only as such. Loops, repeated edges and either direction are welcome;
    edges with a null end are not there. Each round links every node to the smallest of its
    neighbours (large star), then the neighbours of a node to the smallest (small star): the
    edges never become more than they were, and the rounds grow with the logarithm of the
    longest chain. Only two numbers a round come to the driver.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        # each edge counts twice, so no more than HOT_NODES nodes are above it
        limit = max(hot_edges, -(-2 * before[0] // HOT_NODES))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"), F.count("*").alias("n"))
        large = _with_lowest(both, lowest, limit).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = _with_lowest(large, lowest, limit).select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), "low")
        own = lowest.select("a", "low")
        edges = staged(small.union(own).toDF("a", "b").distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
