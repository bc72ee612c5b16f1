"""Connected components of an edge table by alternating star contractions.

Each round replaces every edge by one towards a smaller neighbour (first for
the larger neighbours, then for the smaller ones) until nothing changes; the
edges then are stars around the smallest node of each component. The number
of rounds grows with the logarithm of the graph, and every round is two joins
on staged tables, so a node that holds a third of all edges is split by the
skew-join rule instead of meeting in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import stage, unstage


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of ``edges`` (u > v): larger or smaller neighbours move."""
    if larger:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stage(least, "least")
        moved = edges.toDF("v", "u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = (edges.join(least, "u").where("v <> m").select("v", "m")
                 .union(least.select("u", "m")).toDF("u", "v"))
    out = stage(moved.where("u <> v").distinct(), "edges")
    unstage(least)
    return out


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v of one orderable
    type); root is the smallest node reachable. Loops and null ends are ignored.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "edges")
    mark = _mark(edges)
    while True:
        large = _stars(edges, True)
        small = _stars(large, False)
        unstage(edges, large)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    root = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.union(edges.select("v", "v").distinct())
