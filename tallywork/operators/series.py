"""Sums over window frames of a series, and number and date series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbers(spark: SparkSession, first: int, last: int, name: str = "row_num") -> DataFrame:
    """Whole numbers from first to last, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def series(facts: DataFrame, keys: Sequence[str], step: str, measure: Column, name: str) -> DataFrame:
    """One row per key and step. The frames below work on such a series, whose length
    is the number of steps (days, say) and does not grow with the facts."""
    return facts.groupBy(*keys, step).agg(F.sum(measure).alias(name))


def frame_sum(
    df: DataFrame, keys: Sequence[str], step: str, value: str, preceding: int | None, following: int, name: str
) -> DataFrame:
    """Sum over ROWS from ``preceding`` rows before (None: all) to ``following`` after."""
    start = Window.unboundedPreceding if preceding is None else -preceding
    frame = Window.partitionBy(*keys).orderBy(step).rowsBetween(start, following)
    return df.withColumn(name, F.sum(value).over(frame))


def shift_date(day: Column, years: int = 0, months: int = 0, days: int = 0) -> Column:
    """Months first (kept inside the month), then days."""
    return F.date_add(F.add_months(day, 12 * years + months), days)
