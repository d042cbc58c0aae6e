"""Totals, counts, shares and tops. Every grouping combines map-side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.numbers import percent


def count_rows(df: DataFrame, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, keys: Sequence[str], value: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(value).alias(name))


def total(df: DataFrame, keys: Sequence[str], measure: Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def top_k(df: DataFrame, value: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest value; ties fall to the tiebreak columns."""
    return df.orderBy(F.col(value).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]).limit(k)


def top_per_group(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True) -> DataFrame:
    """Rows that hold the best value of their group, ties kept.

    The filter on the rank lets every map task drop the rest before the shuffle."""
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    ranked = df.withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def one_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, name: str = "_n") -> DataFrame:
    """The first ``n`` rows of every group in the given order."""
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.filter(F.col(name) <= n)
    return kept.drop(name) if name == "_n" else kept


def share_of_total(df: DataFrame, measure: str, name: str, scale: int = 2, whole: Column | None = None) -> DataFrame:
    """Percent of the grand total; ``whole`` gives the total when it is not the sum of the frame."""
    if whole is None:
        whole = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, percent(F.col(measure), whole, scale))


def share_in_group(df: DataFrame, keys: Sequence[str], measure: str, name: str, scale: int = 2) -> DataFrame:
    """Percent of the total of the row's group."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias("_whole"))
    joined = df.join(totals, list(keys))
    return joined.withColumn(name, percent(F.col(measure), F.col("_whole"), scale)).drop("_whole")


def count_when(condition: Column) -> Column:
    """Rows for which the condition holds, as bigint."""
    return F.count(F.when(condition, 1))


def sum_when(condition: Column, measure: Column) -> Column:
    """Sum over the rows for which the condition holds; NULL if there is none."""
    return F.sum(F.when(condition, measure))
