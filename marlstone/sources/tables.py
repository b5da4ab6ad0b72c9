"""Canonical tables from the driver's star schema: image = order, box = line item, class = brand, split = order status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 640.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.expr("CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), split.alias("split"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, line_no, part, supp (tie-breaks), class, score, hit, x1, y1, x2, y2."""
    x1, y1 = F.col("l_partkey") % 500, F.col("l_suppkey") * 7 % 400
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("class"))
    return read(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), "class",
        F.col("l_discount").alias("score"), (F.col("l_returnflag") != "R").alias("hit"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"),
        (x1 + F.col("l_quantity") * 4).alias("x2"), (y1 + F.col("l_extendedprice") / 400).alias("y2"),
    )


#: The same tables for SQL checks.
SQL = """
WITH images AS (SELECT o_orderkey AS image_id, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END AS split FROM orders),
boxes AS (SELECT l_orderkey AS image_id, l_linenumber AS line_no, l_partkey AS part, l_suppkey AS supp, p_brand AS class, l_discount AS score, l_returnflag <> 'R' AS hit,
  (l_partkey % 500)::DOUBLE AS x1, (l_suppkey * 7 % 400)::DOUBLE AS y1, (l_partkey % 500) + l_quantity * 4 AS x2, (l_suppkey * 7 % 400) + l_extendedprice / 400 AS y2
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
