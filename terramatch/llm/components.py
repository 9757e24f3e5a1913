"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _smallest(arcs: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours. Combined on the map side, so a node with very many neighbours is no hot task. It is
    written, so that its join with the arcs has a shuffle of its own on both sides, or none; then Spark splits a node with very many arcs."""
    return durable(arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "smallest")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node that edges (u, v) connect it with. Nodes without an edge don't appear; null ends are left out.

    Each step rewrites the edge table, no larger than before, into the shared folder; two numbers a round go to the driver.
    """
    state, edges = None, durable(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = _smallest(down)
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = durable(small.filter("u <> v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
