"""Connected components by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest node among it and its neighbours."""
    sides = _both(edges)
    # Written before it is joined: a join that stands on an aggregate can't be split where a hub is hot.
    least = checkpointed(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return sides.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = checkpointed(edges.groupBy("hi").agg(F.min("lo").alias("m")))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for each node that has an edge to another; root is the smallest node reachable.

    Self-edges and repeated edges are allowed; edges with a null end are left out. Each round
    is two star operations, whose result is written to the checkpoint folder; the rounds end
    when every edge leads to its root, after about the logarithm of the longest path. Only
    counts and sums reach the driver.
    """
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = checkpointed(now.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    seen = None
    while True:
        # Equal counts and hash sums mean that nothing moved.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        seen = state
        now = checkpointed(small_star(large_star(now)))
