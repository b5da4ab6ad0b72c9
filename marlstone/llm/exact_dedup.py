"""Exact dedup: local winners, salted digest groups, then global winners, full content compared at each stage.

Texts are equal when identical after lower-casing A-Z only; null text counts as empty. The row with the
largest doc_id of a class stays; null doc_ids never win over others, and a class of null doc_ids only
keeps them all (nothing tells them apart). Rows that repeat the winning doc_id are each reported as kept.
An empty table gives no rows. Other columns are ignored. Two texts with one SHA-256 are found by the
content comparison and raise an error rather than being merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stable, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts of one digest's rows that meet apart before the winners of all parts meet.
SALTS = 8


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    d = docs.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("norm"))
    d = d.withColumn("digest", F.unhex(F.sha2("norm", 256)))
    salted = (
        d.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("m"), F.count(F.lit(1)).alias("c"))
    )
    winners = salted.groupBy("digest", "norm").agg(F.max("m").alias("m"), F.sum("c").alias("c"))
    classes = winners.groupBy("digest").agg(F.max("m").alias("keep_id"), F.sum("c").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    classes = classes.select(
        "digest", "keep_id",
        F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("group_size"),
    )
    return (
        d.select("doc_id", "digest")
        .join(stable(classes), "digest")
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""
