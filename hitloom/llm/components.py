"""Connected components of a table of edges, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """The smallest node of each node's component: node, component.  Edges have two longs, a and b.

    Each round gives all neighbours of a node, and the node, to the smallest of them; the number of
    rounds grows with the logarithm of a component's diameter.  Rounds are cut by written tables.
    """
    pairs = edges.select("a", "b").where("a != b").distinct()
    current, count, step = work.keep(pairs, f"{name}-0"), None, 0
    while True:
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours to the smallest neighbour, then the remaining edges to smaller ones to the smallest.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = work.keep(large.where("a != b").distinct(), f"{name}-{step}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        step += 1
        current = work.keep(small, f"{name}-{step}")
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == count:
            break
        count = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
