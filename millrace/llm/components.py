"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of edges (a, b).

    Alternates two steps until nothing changes: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours. Each round is two groupings with partial
    minima, and it is written, so a lost executor costs one round at most. Nodes are numbers
    without null; loops and repeated edges do no harm.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = cut(
        edges.select(larger.alias("a"), smaller.alias("b")).where("a > b").distinct(), "edges"
    )
    state = None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == state:
            break
        state = tuple(sums)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        star = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        lowest = star.groupBy("a").agg(F.min("b").alias("m"))
        down = star.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(down.union(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
