"""Connected components of a graph that no task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import kept_in_shared_folder


def _smallest(links: DataFrame) -> DataFrame:
    """``(v, smallest)`` for the smaller neighbours of each node: counted in the map tasks first."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``: the smallest node that can be reached.

    Two kinds of step alternate until nothing changes: first every node tells its larger neighbours
    the smallest one it knows, then its smaller ones. The edges never become more than nodes plus
    edges, long paths shrink by a factor in each round, and a node with very many links is a plain join
    that adaptive execution can split. Each round is kept in the shared folder. Nodes may be of any type
    that can be ordered. Loops, repeated edges and edges with a null end are left out; without edges
    there are no rows.
    """
    linked = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    stars = kept_in_shared_folder(
        edges.where(linked).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = (
            _smallest(both).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct()
        )
        near = _smallest(up)
        down = near.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        stars = kept_in_shared_folder(down.unionByName(near.select("u", F.col("least").alias("v"))).distinct())
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
