"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the component's smallest node.

    Edges with a null end and loops say nothing and are left out, so a node without an edge to another
    node has no row. Repeated edges count once.

    A round joins every node's larger neighbours, then its smaller ones, to the smallest node it sees
    (Kiveris et al., 2014), which takes a number of rounds that grows with the logarithm of the
    longest path. A hub's neighbours are combined before the shuffle; the join that hands the minimum
    to them has one row per node on one side, so adaptive execution can split the hub's other side.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, step = scratch.save(links, "star-0"), 0
    while not _unfinished(current).isEmpty():
        both = current.select("u", "v").union(current.select(F.col("v"), F.col("u")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.distinct(), f"large-{step}")

        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(lowest.select("u", "m")).distinct()
        following = scratch.save(small, f"star-{step + 1}")
        scratch.drop(f"star-{step}")
        scratch.drop(f"large-{step}")
        current, step = following, step + 1
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _unfinished(links: DataFrame) -> DataFrame:
    """Nodes that keep the edges from being stars: with two parents, or parent and child at once."""
    up = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    roles = up.union(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR (up = 1 AND down = 1)")
