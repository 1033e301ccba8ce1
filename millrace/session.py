"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session somebody else made.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose output feeds an aggregation on the same key is otherwise left
    # unsplit, because splitting costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Folders of a date-partitioned table are listed by this many tasks, not one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "millrace-warehouse"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
