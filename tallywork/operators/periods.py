"""Weekly sales: cleaning, and totals around a date compared between periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.dates import parse_short_year, week_of_month, week_of_year_from_jan1
from tallywork.functions.numbers import growth_percent, percent, ratio
from tallywork.operators.aggregates import sum_when

# Texts of the cleaned columns (fixed values).
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"


# The names of the two sides.
BEFORE, AFTER = "before change", "after change"


def _mapped(key: Column, texts: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in texts.items() for x in pair]
    return F.create_map(*pairs)[key]


def clean_weekly_sales(raw: DataFrame) -> DataFrame:
    """Typed dates, week, month and year numbers, bands from the segment code."""
    day, segment = F.col("week_date_"), F.col("segment")
    missing = segment == "null"
    return raw.withColumn("week_date_", parse_short_year(F.col("week_date"), "d/M/yy")).select(
        "week_date_",
        week_of_month(day).alias("week_number"),
        week_of_year_from_jan1(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.year(day).alias("calendar_year"),
        F.when(missing, UNKNOWN).otherwise(segment).alias("segment"),
        F.when(missing, UNKNOWN).otherwise(_mapped(F.right(segment, F.lit(1)), AGE_BANDS)).alias("age_band"),
        F.when(missing, UNKNOWN).otherwise(_mapped(F.left(segment, F.lit(1)), DEMOGRAPHICS)).alias("demographic"),
        ratio(F.col("sales"), F.col("transactions"), 2).alias("avg_transaction"),
        "region",
        "platform",
        "customer_type",
        "transactions",
        "sales",
    )


def platform_shares(clean: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Transactions of the two platforms and their percent of all."""
    number = F.col("transactions")
    sums = clean.groupBy(*keys).agg(
        sum_when(F.col("platform") == "Retail", number).alias("retail_transactions"),
        sum_when(F.col("platform") == "Shopify", number).alias("shopify_transactions"),
        F.sum(number).alias("total_transactions"),
    )
    return sums.withColumns(
        {
            f"percent_{p}_transactions": percent(F.col(f"{p}_transactions"), F.col("total_transactions"), 2)
            for p in ("retail", "shopify")
        }
    )


def average_two_ways(clean: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ratio of the sums beside the mean of the ratios."""
    sums = clean.groupBy(*keys).agg(
        F.sum("sales").alias("s"),
        F.sum("transactions").alias("t"),
        F.sum("avg_transaction").alias("a"),
        F.count("avg_transaction").alias("n"),
    )
    return sums.select(
        *keys,
        ratio(F.col("s"), F.col("t"), 2).alias("avg_transaction"),
        ratio(F.col("a"), F.col("n"), 2).alias("avg_of_avg_transaction"),
    )


def window_of(day: str, weeks: int, inclusive_end: bool = True) -> tuple[Column, Column]:
    """Conditions for the weeks before a day and for those from it on.

    With ``inclusive_end`` the day exactly ``weeks`` later still counts."""
    pivot = date.fromisoformat(day)
    start, end = pivot - timedelta(weeks=weeks), pivot + timedelta(weeks=weeks)
    if not inclusive_end:
        end -= timedelta(days=1)
    week = F.col("week_date_")
    return (week >= F.lit(start)) & (week < F.lit(pivot)), (week >= F.lit(pivot)) & (week <= F.lit(end))


def side_totals(clean: DataFrame, sides: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Sales per key and side; rows on no side drop out.

    Rows are tagged once and added up, and groups without a side are dropped by
    their count: a filter on the sides themselves would be pushed down to the rows
    and work out the parsed date again for every condition in it."""
    tag = F.lit(None).cast("string")
    for name, condition in reversed(sides.items()):
        tag = F.when(condition, F.lit(name)).otherwise(tag)
    totals = clean.withColumn("changes", tag).groupBy(*keys, "changes").agg(
        F.sum("sales").alias("total_sales"), F.count("changes").alias("_rows")
    )
    return totals.filter(F.col("_rows") > 0).drop("_rows")


def of_side(name: str) -> Column:
    return sum_when(F.col("changes") == name, F.col("total_sales"))


def before_after(clean: DataFrame, day: str, weeks: int) -> DataFrame:
    """Total sales of the two sides, one row each."""
    before, after = window_of(day, weeks)
    return side_totals(clean, {BEFORE: before, AFTER: after})


def before_after_percent(clean: DataFrame, day: str, weeks: int, scale: int) -> DataFrame:
    """Both totals, their difference and growth in one row, from one pass."""
    before, after = window_of(day, weeks)
    sums = side_totals(clean, {"before": before, "after": after}).agg(
        of_side("before").alias("before_sales"), of_side("after").alias("after_sales")
    )
    b, a = F.col("before_sales"), F.col("after_sales")
    return sums.withColumns({"change": a - b, "percent_change": growth_percent(b, a, scale)})


def before_after_years(clean: DataFrame, month_day: str, years: Sequence[int], weeks: int) -> DataFrame:
    """The same window in several years: a row per side, columns per year."""
    sides: dict[str, Column] = {}
    for year in years:
        sides[f"b{year}"], sides[f"a{year}"] = window_of(f"{year}-{month_day}", weeks)
    totals = side_totals(clean, sides).agg(*[of_side(name).alias(name) for name in sides])

    def side(name: str, letter: str) -> Column:
        fields = [F.lit(name).alias("changes")]
        for year in years:
            growth = growth_percent(F.col(f"b{year}"), F.col(f"a{year}"), 3)
            growth = growth if letter == "a" else F.nullif(growth, growth)
            fields += [F.col(f"{letter}{year}").alias(f"sales_{year}"), growth.alias(f"percent_change_{year}")]
        return F.struct(*fields)

    return totals.select(F.inline(F.array(side(BEFORE, "b"), side(AFTER, "a"))))


def impact_by_dimension(clean: DataFrame, dimensions: Sequence[str], day: str, weeks: int) -> DataFrame:
    """Growth around a day for every value of every dimension, from one scan.

    Rows are added up over all dimensions at once before the grouping sets multiply
    them."""
    before, after = window_of(day, weeks)
    totals = side_totals(clean, {"before": before, "after": after}, dimensions)
    sets = totals.groupingSets([[c] for c in dimensions], *dimensions)
    zero = F.lit(0).cast("decimal(18,2)")
    sums = sets.agg(
        F.coalesce(of_side("before"), zero).alias("before_changes"),
        F.coalesce(of_side("after"), zero).alias("after_changes"),
        *[F.grouping(c).alias(f"_{c}") for c in dimensions],
    )
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in reversed(dimensions):
        here = F.col(f"_{c}") == 0
        name, value = F.when(here, F.lit(c)).otherwise(name), F.when(here, F.col(c)).otherwise(value)
    b, a = F.col("before_changes"), F.col("after_changes")
    return sums.select(
        name.alias("dimension"), value.alias("value"), b, a, growth_percent(b, a, 2).alias("percent_change")
    )
