"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import discard, stable


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stable(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stable(down.groupBy("u").agg(F.min("v").alias("m")))
    others = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of each vertex with an edge, from edges (u, v) of any ordered type; component is the smallest id in reach.

    Loops and repeated edges are ignored; no edges give no rows. Per step only the edges move, and a hub meets its
    neighbours as partial minima; the join back is between two tables, so a hub's rows can be split.
    """
    e = stable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    n = e.count()
    for _ in range(rounds):
        large = stable(_large(e))
        after = stable(_small(large))
        discard(large)
        m = after.count()
        settled = m == n and after.join(e, ["u", "v"], "left_anti").isEmpty()  # the same edges: both steps leave them as they are
        discard(e)
        e, n = after, m
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
