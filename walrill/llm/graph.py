"""Connected components of a graph held as a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walrill.llm.common import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and all its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.where(F.col("v") > F.col("u")).join(least, "u")
    return joined.select(F.least("u", "m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of these neighbours. Edges come with a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").unionByName(least.select(F.col("m").alias("a"), "b"))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; a component is named by its least node.

    Hubs are pre-aggregated before each exchange, and the joins are plain equi-joins that adaptive execution can split. Each
    round is written to the shared folder, so a lost executor costs one step. Without edges the result is empty."""
    now = edges.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).where("a <> b").distinct()
    now, mark = materialise(now), None
    while True:
        digest = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (digest["n"], digest["h"]) == mark or not digest["n"]:
            break
        mark = (digest["n"], digest["h"])
        step = materialise(_small_star(_large_star(now).distinct()).distinct())
        discard(now)
        now = step
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
