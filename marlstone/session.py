"""Session defaults. Cluster settings win; these fill in what a plain local session lacks."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", memory)
    b = b.config("spark.sql.shuffle.partitions", str(cpus))
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marlstone-ck-"))
    for k, v in (DEFAULTS | extra).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
