"""Orders against their deliveries: success, waiting time, speed, profit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.dates import minute_boundaries, seconds_between
from tallywork.functions.numbers import percent, ratio


def delivered() -> Column:
    """A distance other than zero; false for NULL."""
    return F.col("distance") != 0


def not_cancelled() -> Column:
    return F.col("cancellation").isNull() | ~F.col("cancellation").endswith("Cancellation")


def speed_kmh(scale: int = 2) -> Column:
    """km per hour; NULL without a distance or a duration."""
    return ratio(F.col("distance").cast("decimal(18,2)") * 60, F.col("duration"), scale)


def waits(item_counts: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Delivered orders with their number of items and the wait until pickup."""
    joined = item_counts.join(deliveries.filter(delivered()), "order_id")
    return joined.withColumns(
        {
            "wait_seconds": seconds_between(F.col("order_time"), F.col("pickup_time")),
            "wait_marks": minute_boundaries(F.col("order_time"), F.col("pickup_time")),
        }
    )


def avg_wait_by_runner(waiting: DataFrame) -> DataFrame:
    """Mean wait in minutes; every item of an order counts once."""
    per_runner = waiting.groupBy("runner_id").agg(
        F.sum(F.col("wait_seconds") * F.col("items")).alias("s"), F.sum("items").alias("n")
    )
    return per_runner.select("runner_id", ratio(F.col("s"), F.col("n") * 60, 0).alias("pickup_minutes"))


def avg_wait_overall(waiting: DataFrame) -> DataFrame:
    """Mean of the minute marks per order above one, cut to whole minutes."""
    long = waiting.filter(F.col("wait_marks") > 1)
    return long.agg(F.floor(F.sum("wait_marks") / F.count(F.lit(1))).cast("int").alias("avg_pickup_minutes"))


def prep_time_by_size(waiting: DataFrame) -> DataFrame:
    """Mean of the rounded wait by the number of items in the order."""
    minutes = ratio(F.col("wait_seconds"), F.lit(60), 0).cast("bigint")
    sums = waiting.groupBy(F.col("items").alias("number_of_items")).agg(
        F.sum(minutes).alias("s"), F.count(F.lit(1)).alias("n")
    )
    return sums.select("number_of_items", ratio(F.col("s"), F.col("n"), 2).alias("avg_minutes"))


def avg_distance(item_counts: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Mean distance per customer; every item of an order counts once."""
    joined = item_counts.join(deliveries, "order_id")
    km = F.col("distance").cast("decimal(18,2)") * F.col("items")
    sums = joined.groupBy("customer_id").agg(
        F.sum(km).alias("s"), F.sum(F.when(F.col("distance").isNotNull(), F.col("items"))).alias("n")
    )
    return sums.select("customer_id", ratio(F.col("s"), F.col("n"), 2).alias("avg_distance"))


def success_percent(deliveries: DataFrame) -> DataFrame:
    counts = deliveries.groupBy("runner_id").agg(
        F.count(F.when(F.col("cancellation").isNull(), 1)).alias("ok"), F.count(F.lit(1)).alias("n")
    )
    return counts.select("runner_id", percent(F.col("ok"), F.col("n"), 2).alias("percentage_successful"))


def delivery_facts(item_counts: DataFrame, deliveries: DataFrame, rating: Column) -> DataFrame:
    """One row per order with its times, speed, size and rating."""
    return item_counts.join(deliveries, "order_id").select(
        "customer_id",
        "order_id",
        "runner_id",
        "order_time",
        "pickup_time",
        seconds_between(F.col("order_time"), F.col("pickup_time")).alias("wait_seconds"),
        "duration",
        speed_kmh().alias("avg_speed"),
        F.col("items").alias("number_of_items"),
        rating.alias("rating"),
    )


def profit(order_totals: DataFrame, deliveries: DataFrame, per_km: str) -> DataFrame:
    """Revenue of driven orders minus what the kilometres cost."""
    driven = order_totals.join(deliveries.filter(F.col("distance").isNotNull()), "order_id")
    cost = F.col("distance").cast("decimal(18,2)") * F.lit(per_km).cast("decimal(6,2)")
    return driven.agg((F.sum("order_total") - F.sum(cost)).alias("total_profit"))
