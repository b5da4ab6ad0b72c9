"""Running sums and maxima of one long group, dealt over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_hits(df: DataFrame, group: list[str], score: str, ties: list[str], hit: str, steps: int = 1000) -> DataFrame:
    """Adds k and tp: rank by falling score and hits up to it, within the group.

    Scores in [0, 1] are cut into `steps` bands; bands are counted, their offsets are sums over at most steps + 1 rows a group,
    and only rows of one band are sorted together, so a class with most predictions is dealt over its bands.
    """
    band = F.floor((1 - F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0))) * steps)
    d = df.withColumn("_band", band)
    sums = d.groupBy(*group, "_band").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(hit).cast("long")).alias("_h"))
    before = Window.partitionBy(*group).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(*group, "_band", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_k0"), F.coalesce(F.sum("_h").over(before), F.lit(0)).alias("_h0"))
    own = Window.partitionBy(*group, "_band").orderBy(F.desc(score), *ties)
    return d.join(offs, [*group, "_band"]).withColumn("k", F.col("_k0") + F.row_number().over(own)).withColumn("tp", F.col("_h0") + F.sum(F.col(hit).cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0))).drop("_k0", "_h0")


def envelope(ranked: DataFrame, group: list[str], value: Column) -> DataFrame:
    """Adds envelope: the greatest value at this rank or a later one; from ranked_hits, whose bands it reuses."""
    d = ranked.withColumn("_v", value)
    later = Window.partitionBy(*group).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    tops = d.groupBy(*group, "_band").agg(F.max("_v").alias("_m")).select(*group, "_band", F.max("_m").over(later).alias("_later"))
    own = Window.partitionBy(*group, "_band").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    return d.join(tops, [*group, "_band"]).withColumn("envelope", F.greatest(F.max("_v").over(own), F.coalesce("_later", F.lit(0.0)))).drop("_v", "_later")


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is not positive."""
    return F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))


def ordered_ranks(df: DataFrame, group: list[str], key: str, ties: list[str], out: str, bands: int = 1024) -> DataFrame:
    """Adds `out`: the rank from 0 by a numeric key within the group, and total: the group's rows.

    The group's keys are cut into equal ranges; ranges are counted, their offsets are sums over at most `bands` rows a group, and only
    rows of one range are sorted together. Ranges are even when keys are spread, as ids are. Keys must not be null.
    """
    ends = df.groupBy(*group).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    d = df.join(ends, group).withColumn("_band", F.floor((F.col(key) - F.col("_lo")) * bands / (F.col("_hi") - F.col("_lo") + 1)))
    counts = d.groupBy(*group, "_band").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group)
    offs = counts.select(*group, "_band", F.coalesce(F.sum("_n").over(w.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_k0"), F.sum("_n").over(w).alias("total"))
    own = Window.partitionBy(*group, "_band").orderBy(key, *ties)
    return d.join(offs, [*group, "_band"]).withColumn(out, F.col("_k0") + F.row_number().over(own) - 1).drop("_band", "_k0", "_lo", "_hi")
