"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or not larger) neighbours of every node on its smallest neighbour."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # In the small star u is the larger end; v and u itself move below the smallest v.
    least = around.groupBy("u").agg(F.min("v").alias("low"))
    low = F.least("u", "low")
    if large:
        moved = around.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), low.alias("v"))
    else:
        moved = around.join(least, "u").select(F.col("v").alias("u"), low.alias("v")).unionByName(
            least.select("u", low.alias("v"))
        )
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v long): root is the smallest node it reaches.

    Each round is written to the shared folder. Raises if it has not settled after ``rounds``.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    seen = None
    for _ in range(rounds):
        now = materialise(_star(_star(now, True), False), "components")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = mark
    raise RuntimeError(f"components did not settle in {rounds} rounds")
