"""Connected components of an edge table by alternating large and small stars.

Every round rewrites the edges towards the smallest id each node has seen;
rounds are staged in the shared checkpoint folder. Hot nodes are reduced with
a partial minimum before the shuffle, and the join back has one row for each
node on its right side, so a hot node's edges can be split by the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import stage


def _least(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")).withColumnRenamed("u", "x")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    return (both.where("v > u").join(least, both["u"] == least["x"])
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    joined = down.join(least, down["u"] == least["x"])
    return (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
            .where("u <> v").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that ``edges`` (u, v) mentions; the
    component is its smallest id. Loops, repeats and nulls are ignored."""
    e = stage(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        e = stage(_small_star(_large_star(e)), "edges")
        mark = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
