"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node reachable) for every node that an edge has.

    In each round every node joins its smallest neighbour and the edges move to the nodes
    joined, so the edges at least halve; each round is written to the shared folder. Repeated
    edges, loops and nulls do no harm.
    """
    edges = stage(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges"
    )
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = stage(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")).select(F.col("a").alias("v"), "p"), "parents"
        )
        if roots is None:
            roots = parent.select(F.col("v").alias("node"), F.col("p").alias("root"))
        else:
            moved = roots.join(parent, roots["root"] == parent["v"], "left")
            roots = stage(moved.select("node", F.coalesce("p", "root").alias("root")), "roots")
        to_a, to_b = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        edges = stage(
            edges.join(to_a, "a").join(to_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).filter("a <> b").distinct(),
            "edges",
        )
    return edges.toDF("node", "root") if roots is None else roots
