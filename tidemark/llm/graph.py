"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (u, v): root is the least node that can be reached.

    Loops and repeated edges do not matter; an empty table gives no rows. Each round is a written
    table; nothing but a count and a checksum reaches the driver. Neighbourhoods are only reduced to
    their least node, never gathered.
    """
    state = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(ROUNDS):
        found = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if found[0] == 0 or tuple(found) == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(found)
        state = materialise(_small_star(_large_star(state)))
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
