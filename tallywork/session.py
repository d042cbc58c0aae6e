"""Session settings shared by the tests, the benchmark and the examples."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold for a laptop and for a cluster alike. Everything about size
# (executors, memory, number of shuffle partitions) is left to the caller.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """One-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallywork")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
