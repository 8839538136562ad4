"""Connected components of a graph given by its edges, as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step
joins the edges with the smallest neighbour of each node and rehangs them, so
that every component ends as a star around its smallest node after about
log(n) rounds. Smallest neighbours are combined before the shuffle; the join
back is a sort-merge join whose hot keys adaptive execution splits. Each round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.session import written_once


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from a node to a smaller one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each node with an edge; ``root`` is the component's smallest node.

    ``edges`` has long columns a and b; loops and repeated edges do no harm. Nulls
    must be left out before. An empty table gives an empty result.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written_once(edges, label)
    before = None
    while True:
        edges = written_once(_small_star(_large_star(edges)).where("a <> b").distinct(), label)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
