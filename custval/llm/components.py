"""Connected components by alternating stars, each a grouped minimum and a join.

A large star links every larger neighbour of a node to the smallest one it
knows, a small star does so for the smaller neighbours; repeated until nothing
changes, every node points at the smallest of its component.  No group is
gathered: minima combine before the shuffle, and a hub's rows are dealt over
several tasks by ``join_hot`` (the minima are aggregated on the join's own key,
so the adaptive skew rule would not split them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.operators.joins import join_hot
from custval.operators.persist import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (join_hot(both.where("v > u"), least, ["u"], salt_by=["v"])
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_hot(down, least, ["u"], salt_by=["v"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u long, v long; u <> v) that is not the smallest of its component."""
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).head()

    now = state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)))
        before, now = now, state(edges)
        if now == before:
            return edges.select("u", F.col("v").alias("root"))
