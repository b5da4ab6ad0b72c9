"""Helpers shared by the operators: table reads, durable cuts of lineage, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset and the master is local (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="marlstone-ck-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def stable(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/marlstone/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._marlstone_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table made by stable() that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._marlstone_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Hash-key ranges per group in distributed prefix sums; three hex digits of an md5.
RANGES = 4096


def hash_key(*parts: Column | str) -> Column:
    """A hash-random sort key, the same in any engine that has md5."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat(*cols))


def key_range(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def prefix_sums(df: DataFrame, group: list[str], value: str, key: str, ties: list[str], out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the same group that come before in (key, ties) order.

    Rows are cut into RANGES ranges of the hash key, summed per range, and only those sums meet per group;
    so a group of any size is dealt over RANGES tasks. Group columns must not be null.
    """
    d = df.withColumn("_range", key_range(F.col(key)))
    sums = d.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(*group, "_range", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*group, "_range").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        d.join(offs, [*group, "_range"])
        .withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .drop("_range", "_off")
    )


def ranks(df: DataFrame, group: list[str], key: str, ties: list[str], out: str) -> DataFrame:
    """Adds `out`: the gapless rank from 0 within the group."""
    return prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), group, "_one", key, ties, out).drop("_one")
