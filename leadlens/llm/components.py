"""Connected components of an edge table, by repeated joins with small labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for each node of ``edges`` (``a``, ``b``).

    Large-star and small-star steps: each node links its larger neighbours, then all its neighbours, to the smallest
    one. Every step is an aggregation with map-side combine and a join, so a node with very many neighbours
    is no single task; each round is written to the shared folder. Ends when a round changes nothing.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        low = low.select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select("u", F.col("low").alias("v")).union(small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))).distinct()
        now = stage(small, "edges")
        # Stars are stable: as many edges as nodes beside the roots, and the same sum as before.
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mix")).first()
        if before == tuple(state):
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
