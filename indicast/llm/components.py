"""Connected components of a graph given as pairs of 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import Shelf


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; root is the smallest node.

    Alternates two star operations until nothing changes: every node ties its
    larger neighbours, then its smaller ones, to the smallest node it knows.
    The number of rounds grows with the logarithm of a component's size. Each
    round is two aggregates with partial minima and two joins on the node,
    which adaptive execution splits for a hub; no neighbourhood is collected.
    An empty table of edges gives an empty result."""
    now = shelf.keep(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges-0")
    before, step = None, 0
    while True:
        near = _both_ways(now)
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.filter("u <> m").select("u", F.col("m").alias("v"))).distinct())
        large = shelf.keep(large, f"large-{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        after = shelf.keep(small, f"edges-{step + 1}")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        shelf.drop(f"edges-{step}")
        shelf.drop(f"large-{step}")
        now, step = after, step + 1
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
