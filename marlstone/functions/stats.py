"""Distribution statistics over grouped counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_rank(values: Column, q: float) -> Column:
    """Element number ceil((n - 1) q) of the sorted array, counted from 0; null for an empty one."""
    return F.try_element_at(F.sort_array(values), (F.ceil((F.size(values) - 1) * F.lit(q)) + 1).cast("int"))


def js_term(p: Column, q: Column) -> Column:
    """One class's share of the Jensen-Shannon divergence in bits; zero shares are skipped."""
    mid = (p + q) / 2
    part = lambda a: F.when((a > 0) & (mid > 0), a * F.log2(a / mid)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def distribution_metrics(counts: DataFrame, group: list[str], value: str) -> DataFrame:
    """Total, nearest ranks over positive counts, shares, population variation, Gini and evenness over all counts."""
    a = counts.groupBy(*group).agg(F.sort_array(F.collect_list(F.col(value).cast("double"))).alias("v"))  # one entry per class
    n, total = F.size("v"), F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    a = a.withColumn("n", n).withColumn("total", total).withColumn("pos", F.filter("v", lambda x: x > 0))
    mean = F.col("total") / F.col("n")
    spread = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.col("n"))
    ranked = F.aggregate(F.transform("v", lambda x, i: (i + 1) * x), F.lit(0.0), lambda s, x: s + x)
    entropy = F.aggregate("v", F.lit(0.0), lambda s, x: s - F.when(x > 0, x / F.col("total") * F.log(x / F.col("total"))).otherwise(F.lit(0.0)))
    top = lambda k: F.aggregate(F.slice(F.reverse("v"), 1, k), F.lit(0.0), lambda s, x: s + x) / F.col("total")
    return a.select(
        *group, F.col("n").cast("long").alias("class_count"), F.size("pos").cast("long").alias("active_class_count"), F.col("total").cast("long").alias("total"),
        F.array_min("pos").cast("long").alias("min_count"), *[nearest_rank(F.col("pos"), q).cast("long").alias(name) for q, name in ((0.5, "median"), (0.75, "p75"), (0.9, "p90"))],
        F.array_max("pos").cast("long").alias("max_count"), top(1).alias("top1_share"), top(3).alias("top3_share"), (spread / mean).alias("variation"),
        (2 * ranked / (F.col("n") * F.col("total")) - (F.col("n") + 1) / F.col("n")).alias("gini"),
        F.when(F.col("n") > 1, entropy / F.log("n")).otherwise(F.lit(1.0)).alias("evenness"),
    )
