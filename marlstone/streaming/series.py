"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_write_wins(stream: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Per key the value with the greatest time, the first one seen on ties; batch or stream (update or complete mode)."""
    last = F.max_by(F.struct(F.col(at), F.col(value)), F.col(at))
    return stream.where(F.col(at).isNotNull()).groupBy(*keys).agg(last.alias("_m")).select(*keys, F.col(f"_m.{at}").alias(at), F.col(f"_m.{value}").alias(value))


def scan_new(spark, schema, source: str, sink: str, checkpoint: str, bad: str, is_bad) -> None:
    """Read files that arrived since the last call once, bad rows to a side table; a null predicate is not bad.

    A batch is written under its number, so one that is repeated after a failure replaces itself.
    """

    def write(batch: DataFrame, n: int) -> None:
        is_it = F.coalesce(is_bad, F.lit(False))
        batch.where(~is_it).write.mode("overwrite").parquet(f"{sink}/batch={n}")
        batch.where(is_it).write.mode("overwrite").parquet(f"{bad}/batch={n}")

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
