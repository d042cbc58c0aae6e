"""Events per hour as they arrive: the batch count by hour of day, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number of them per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def counts_per_hour(events: DataFrame, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Events per clock hour. Hours older than the watermark are closed and leave the state."""
    stamped = events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    counts = stamped.groupBy(F.window("_at", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("hour"), "n")


def by_hour_of_day(counts: DataFrame) -> DataFrame:
    """Hourly counts to counts per hour of day."""
    return counts.groupBy(F.hour("hour").alias("hour_of_day")).agg(F.sum("n").alias("n"))
