"""Facts against one event date per entity: before, after, first, last, flagged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.operators.aggregates import one_per_group
from tallywork.operators.skew import HOT_ROWS, join_salted, value_rank


def after_event(
    facts: DataFrame, events: DataFrame, key: str, date: str, event_date: str, hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Facts strictly later than the event of their entity."""
    return join_salted(facts, events, [key], hot_rows=hot_rows, counted=counted).filter(F.col(date) > F.col(event_date))


def before_event(
    facts: DataFrame, events: DataFrame, key: str, date: str, event_date: str, hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Facts strictly earlier than the event of their entity."""
    return join_salted(facts, events, [key], hot_rows=hot_rows, counted=counted).filter(F.col(date) < F.col(event_date))


def first_after(
    facts: DataFrame, events: DataFrame, key: str, date: str, event_date: str, hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Facts of the first day after the event; all of that day are kept."""
    later = after_event(facts, events, key, date, event_date, hot_rows, counted)
    window = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())
    return later.withColumn("_rank", F.rank().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def last_before(
    facts: DataFrame,
    events: DataFrame,
    key: str,
    date: str,
    event_date: str,
    tiebreak: Sequence[str],
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The one fact closest before the event (as-of)."""
    earlier = before_event(facts, events, key, date, event_date, hot_rows, counted)
    return one_per_group(earlier, [key], [F.col(c).desc_nulls_last() for c in (date, *tiebreak)])


def event_flag(
    facts: DataFrame,
    events: DataFrame,
    key: str,
    date: str,
    event_date: str,
    name: str = "member",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """'Y' from the event on, 'N' before it and for entities without one."""
    flagged = join_salted(facts, events, [key], "left", hot_rows, counted=counted)
    return flagged.withColumn(name, F.when(F.col(date) >= F.col(event_date), "Y").otherwise("N")).drop(event_date)


def masked_rank(df: DataFrame, keys: Sequence[str], flag: str, order: str, name: str, descending: bool = False) -> DataFrame:
    """Rank among the rows of the same key and flag; NULL where the flag is 'N'."""
    ranked = value_rank(df, [*keys, flag], order, "_rank", descending=descending)
    return ranked.withColumn(name, F.when(F.col(flag) != "N", F.col("_rank"))).drop("_rank")


def tiered(condition: Column, measure: Column, base: int, factor: int) -> Column:
    """``base`` points per unit, ``factor`` times as many where the condition holds."""
    return measure * F.when(condition, base * factor).otherwise(base)
