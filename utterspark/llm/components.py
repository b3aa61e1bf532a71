"""Connected components of an edge table, all in Spark.

Alternating large-star and small-star steps: every step links nodes to the smallest neighbour, so
chains shrink by about half a round and a star settles at once. A hub's edges are joined on the hub,
where AQE splits a skewed partition; the minimum per node is a partial aggregate. Each round ends in
a checkpoint in the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.session import ensure_checkpoint_dir

MAX_ROUNDS = 60


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) with v < u -> (u, smallest node of u's closed neighbourhood among the smaller ones)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every node of ``edges`` that is not its own root; root is the smallest id
    reachable. Null ends and loops are ignored; an empty edge table gives an empty result."""
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct()
         .checkpoint(eager=True))
    before = None
    for _ in range(MAX_ROUNDS):
        e = _star(_large_star(e)).checkpoint(eager=True)
        # order-free digest of the edge set: unchanged edges mean that every node points at its root
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
