"""Mixing sources to target weights, in DataFrame functions only.

Size: words of the text (runs of characters other than space and \\t..\\r; null: 0). Sources are ranked by code
point, null last as a source of its own, and weigh 5, 2, 1, repeating. Together they get 150 % of all words;
a target stops at twice its source's words and the excess goes to the others by weight until none is above.
Each source's documents get hash-random keys, are sorted by them within key ranges, and prefix sums of
words over the ranges cut at exactly floor(target) words: whole epochs first, then the last epoch up to the
cut, where the document at the cut gives part of its words. No document gives more than twice its words.
Rows that repeat doc_id and size share the key; their amounts are the same as a set. Null doc_ids share one
key and are told apart by size. An empty table gives no rows; documents without words take 0.

Only the table of sources (one row each) is sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm.common import hash_key, key_range, table

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1:"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """From (skey, source_size): adds target. Water filling: sources in order of cap over weight are full until the level fits."""
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.col("w_left"))
        .withColumn("pos", F.row_number().over(by_level))
    )
    open_ = F.when(F.col("cap") > F.col("w") * F.col("level"), F.col("pos"))
    s = s.withColumn("first", F.min(open_).over(everything))
    s = s.withColumn("final", F.max(F.when(F.col("pos") == F.col("first"), F.col("level"))).over(everything))
    full = F.col("first").isNull() | (F.col("pos") < F.col("first"))
    return s.select("skey", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(F.col("w") * F.col("final")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; `keep` carries further columns of docs, named keep_<column>."""
    src = F.col(source_col).cast("string")
    d = docs.select(
        F.col(id_col).alias("doc_id"), n_words(F.col(text_col)).alias("size"),
        F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src)).alias("skey"),
        hash_key(seed, F.col(id_col)).alias("key"),
        *[F.col(c).alias(f"keep_{c}") for c in keep],
    ).withColumn("part", key_range(F.col("key")))
    parts = d.groupBy("skey", "part").agg(F.sum("size").alias("part_size"))
    plan = targets(parts.groupBy("skey").agg(F.sum("part_size").alias("source_size")))
    before = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("off", F.coalesce(F.sum("part_size").over(before), F.lit(0))).join(plan, "skey").drop("part_size")
    inner = Window.partitionBy("skey", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.coalesce(F.expr("floor(target) div nullif(source_size, 0)"), F.lit(0))
    left = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("prefix")))
    return (
        d.join(offsets, ["skey", "part"])
        .withColumn("prefix", F.col("off") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *[f"keep_{c}" for c in keep])
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey, md5('{SEED}' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s0 AS (SELECT skey, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap FROM d GROUP BY skey),
s1 AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(skey)) - 1) % 3 + 1)::INT]::BIGINT AS w FROM s0),
s2 AS (SELECT *, row_number() OVER lv AS pos,
    ((sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(cap) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / ((sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS level
  FROM s1 WINDOW lv AS (ORDER BY cap / w, encode(skey))),
s3 AS (SELECT *, min(CASE WHEN cap > w * level THEN pos END) OVER () AS first FROM s2),
s4 AS (SELECT *, max(CASE WHEN pos = first THEN level END) OVER () AS final FROM s3),
s AS (SELECT skey, source_size, CASE WHEN first IS NULL OR pos < first THEN cap::DOUBLE ELSE w * final END AS target FROM s4),
p AS (SELECT d.*, source_size, target, coalesce(floor(target)::BIGINT // nullif(source_size, 0), 0) AS epochs,
    coalesce(sum(size) OVER (PARTITION BY skey ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prefix
  FROM d JOIN s USING (skey))
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - prefix)))::BIGINT AS taken
FROM p
"""
