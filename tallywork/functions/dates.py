"""Date helpers whose meaning is fixed here once (week base, day names, spans)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_short_year(text: Column, pattern: str) -> Column:
    """Text with a two-digit year to a date: 70-99 are 1970-1999, 00-69 are 2000-2069."""
    parsed = F.to_date(text, pattern)
    return F.when(F.year(parsed) >= 2070, F.add_months(parsed, -1200)).otherwise(parsed)


def weekday_number(d: Column) -> Column:
    """Day of week, Sunday = 0."""
    return F.dayofweek(d) - F.lit(1)


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def weeks_from(d: Column, anchor: str) -> Column:
    """1 for the seven days that start at ``anchor``, 2 for the next seven, ..."""
    days = F.datediff(d, F.lit(anchor).cast("date"))
    return (F.floor(days / F.lit(7)) + 1).cast("int")


def week_of_month(d: Column) -> Column:
    """1 for days 1-7, ... 5 for days 29-31."""
    return F.floor((F.dayofmonth(d) - 1) / F.lit(7)).cast("int") + 1


def week_of_year_from_jan1(d: Column) -> Column:
    """1 for 1-7 January, 2 for 8-14 January, ..."""
    return F.floor((F.dayofyear(d) - 1) / F.lit(7)).cast("int") + 1


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, as bigint."""
    return F.timestamp_diff("SECOND", start, end)


def minute_boundaries(start: Column, end: Column) -> Column:
    """How many minute marks lie between two times."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def calendar_months_between(start: Column, end: Column) -> Column:
    """Difference of the calendar months, days ignored: Jan 31 -> Feb 1 is 1."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def days_span(start: Column, end: Column, inclusive: bool = True) -> Column:
    """Days from start to end; with ``inclusive`` both ends count."""
    return F.datediff(end, start) + F.lit(1 if inclusive else 0)
