"""Monthly figures per interest: coverage, extremes and leaders per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.numbers import percent, ratio


def with_month(metrics: DataFrame) -> DataFrame:
    """Month text ``MM-yyyy`` to the first day of the month; NULL stays NULL."""
    return metrics.withColumn("month_start", F.to_date("month_year", "MM-yyyy")).drop("month_year")


def missing_both_ways(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys each side has that the other has not (one row)."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only_left = a.join(b, key, "left_anti").agg(F.count(F.lit(1)).alias("only_left"))
    only_right = b.join(a, key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return only_left.withColumn("only_right", only_right.scalar())


def months_per_interest(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("month_start").isNotNull()).groupBy("interest_id").agg(
        F.countDistinct("month_start").alias("total_months"), F.count(F.lit(1)).alias("points")
    )


def in_all_months(metrics: DataFrame) -> DataFrame:
    """Interests with figures in every month that occurs."""
    whole = metrics.agg(F.countDistinct("month_start")).scalar()
    return months_per_interest(metrics).filter(F.col("total_months") == whole).select("interest_id", "total_months")


def cumulative_percent(metrics: DataFrame) -> DataFrame:
    """Interests by number of months, and the running percent from the most months down.

    The windows run over one row per number of months."""
    counts = months_per_interest(metrics).groupBy("total_months").agg(F.count(F.lit(1)).alias("interests"))
    down = Window.orderBy(F.col("total_months").desc())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = percent(F.sum("interests").over(down), F.sum("interests").over(whole), 2)
    return counts.withColumn("cumulative_percent", share)


def points_removed(metrics: DataFrame, min_months: int) -> DataFrame:
    few = months_per_interest(metrics).filter(F.col("total_months") < min_months)
    return few.agg(F.coalesce(F.sum("points"), F.lit(0)).cast("bigint").alias("points_removed"))


def kept(metrics: DataFrame, min_months: int) -> DataFrame:
    """Figures of the interests with enough months."""
    enough = months_per_interest(metrics).filter(F.col("total_months") >= min_months).select("interest_id")
    return metrics.join(enough, "interest_id", "left_semi")


def maximum_per_interest(metrics: DataFrame) -> DataFrame:
    """Largest composition of every interest, with the first month that had it."""
    newest_last = F.struct("composition", -F.unix_date("month_start"))
    return metrics.filter(F.col("month_start").isNotNull()).groupBy("interest_id").agg(
        F.max("composition").alias("composition"), F.max_by("month_start", newest_last).alias("month_start")
    )


def top_and_bottom(df: DataFrame, value: str, tiebreak: str, n: int) -> DataFrame:
    top = df.orderBy(F.col(value).desc(), F.col(tiebreak)).limit(n).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(value).asc(), F.col(tiebreak)).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def lowest_average(metrics: DataFrame, value: str, n: int) -> DataFrame:
    means = metrics.groupBy("interest_id").agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    named = means.select("interest_id", ratio(F.col("s"), F.col("n"), 4).alias(f"avg_{value}"))
    return named.orderBy(f"avg_{value}", "interest_id").limit(n)


def deviation(value: str) -> Column:
    """Sample standard deviation from exact sums, so it doesn't depend on their order."""
    x = F.col(value).cast("decimal(14,4)")
    n, total, squares = F.count(value), F.sum(x), F.sum((x * x).cast("decimal(28,8)"))
    spread = (n.cast("decimal(18,0)") * squares).cast("double") - F.pow(total.cast("double"), 2)
    exact = F.when(n > 1, F.greatest(spread, F.lit(0.0)) / (n.cast("double") * (n - 1).cast("double")))
    return F.round(F.sqrt(exact), 6)


def largest_deviation(metrics: DataFrame, value: str, n: int) -> DataFrame:
    spread = metrics.groupBy("interest_id").agg(deviation(value).alias("deviation"))
    return spread.orderBy(F.col("deviation").desc_nulls_last(), "interest_id").limit(n)


def extremes_of_varied(metrics: DataFrame, value: str, min_months: int, n: int) -> DataFrame:
    """Smallest and largest value, each with its first month, of the interests with enough months
    that vary most. One grouping has all of it."""
    month = F.col("month_start")
    day, dated = F.unix_date(month), month.isNotNull()
    figures = metrics.groupBy("interest_id").agg(
        F.countDistinct(month).alias("months"),
        deviation(value).alias("deviation"),
        F.min(F.when(dated, F.col(value))).alias("min_value"),
        F.min_by(month, F.when(dated, F.struct(value, day))).alias("min_month"),
        F.max(F.when(dated, F.col(value))).alias("max_value"),
        F.max_by(month, F.when(dated, F.struct(F.col(value), -day))).alias("max_month"),
    )
    varied = figures.filter(F.col("months") >= min_months).orderBy(F.col("deviation").desc_nulls_last(), "interest_id").limit(n)
    return varied.filter(F.col("min_month").isNotNull()).drop("months", "deviation")


def average_composition(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("avg_composition", ratio(F.col("composition"), F.col("index_value"), 2))


def top_per_month(metrics: DataFrame, n: int) -> DataFrame:
    """Interests ranked up to ``n`` by average composition in their month, ties kept."""
    dated = average_composition(metrics).filter(F.col("month_start").isNotNull())
    order = Window.partitionBy("month_start").orderBy(F.col("avg_composition").desc_nulls_last())
    ranked = dated.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= n)
    return ranked.select("month_start", "interest_id", "avg_composition", "rank")


def leaders_with_previous(metrics: DataFrame, lags: Sequence[int] = (1, 2)) -> DataFrame:
    """Leader of each month, mean of three months and the leaders before.

    The windows run over one row per month."""
    best = F.struct(F.col("avg_composition"), -F.col("interest_id"))
    leaders = (
        average_composition(metrics)
        .filter(F.col("month_start").isNotNull())
        .groupBy("month_start")
        .agg(F.max("avg_composition").alias("max_value"), F.max_by("interest_id", best).alias("interest_id"))
    )
    months = Window.orderBy("month_start")
    three = months.rowsBetween(-2, 0)
    mean: Column = ratio(F.sum("max_value").over(three), F.count("max_value").over(three), 2)
    columns = {"rolling_3_months": mean}
    for k in lags:
        columns[f"leader_{k}_before"] = F.lag("interest_id", k).over(months)
        columns[f"value_{k}_before"] = F.lag("max_value", k).over(months)
    return leaders.withColumns(columns)
