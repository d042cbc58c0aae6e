"""Plan histories: what follows what, who is on what, when to pay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.dates import calendar_months_between
from tallywork.functions.numbers import percent, ratio, upper_inclusive_band
from tallywork.operators.aggregates import count_when, one_per_group
from tallywork.operators.skew import shift_rows

ORDER = ["start_date", "event_id"]


def by_day_and_id(block: int = 100_000) -> list[Column]:
    """Slices of a history: the day, then blocks of ids."""
    return [F.col("start_date"), F.floor(F.col("event_id") / block)]


def next_plans(subs: DataFrame) -> DataFrame:
    """Every subscription with the plan that follows it by date."""
    return shift_rows(subs, ["customer_id"], ORDER, {"next_plan_id": "plan_id"}, by_day_and_id())


def customers(subs: DataFrame) -> Column:
    """Number of customers, as a scalar."""
    return subs.agg(F.countDistinct("customer_id")).scalar()


def churn_rate(subs: DataFrame, churn: int) -> DataFrame:
    left = subs.filter(F.col("plan_id") == churn)
    counts = left.agg(F.count(F.lit(1)).alias("churn_events"), F.countDistinct("customer_id").alias("churned_customers"))
    return counts.withColumn("churn_percentage", percent(F.col("churned_customers"), customers(subs), 1))


def second_plan_is(subs: DataFrame, plan: int) -> DataFrame:
    """Customers whose second subscription is the given plan."""
    firsts = one_per_group(subs, ["customer_id"], [F.col(c).asc_nulls_last() for c in ORDER], n=2, name="plan_number")
    hits = firsts.filter((F.col("plan_number") == 2) & (F.col("plan_id") == plan))
    counts = hits.agg(F.countDistinct("customer_id").alias("churned_customers"))
    return counts.withColumn("churn_percentage", percent(F.col("churned_customers"), customers(subs), 0))


def followed_by(subs: DataFrame, plan: int, following: int) -> DataFrame:
    """Customers with a subscription to one plan directly followed by another."""
    hits = next_plans(subs).filter((F.col("plan_id") == plan) & (F.col("next_plan_id") == following))
    counts = hits.agg(F.countDistinct("customer_id").alias("churned_customers"))
    return counts.withColumn("churn_percentage", percent(F.col("churned_customers"), customers(subs), 0))


def next_plan_share(subs: DataFrame, plan: int) -> DataFrame:
    """What follows a plan: count per next plan, and percent of all customers."""
    moves = next_plans(subs).filter((F.col("plan_id") == plan) & F.col("next_plan_id").isNotNull())
    counts = moves.groupBy(F.col("next_plan_id").alias("plan_id")).agg(F.count(F.lit(1)).alias("converted_customers"))
    return counts.withColumn("conversion_percentage", percent(F.col("converted_customers"), customers(subs), 1))


def plan_mix_at(subs: DataFrame, plans: DataFrame, day: str) -> DataFrame:
    """Latest plan of every customer up to a day: customers and percent per plan."""
    so_far = subs.filter(F.col("start_date") <= F.lit(day).cast("date"))
    current = so_far.groupBy("customer_id").agg(F.max_by("plan_id", F.struct(*ORDER)).alias("plan_id"))
    counts = current.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customers"))
    return counts.join(plans.select("plan_id", "plan_name"), "plan_id").withColumn(
        "percentage", percent(F.col("customers"), customers(subs), 1)
    )


def days_to_plan(subs: DataFrame, plan: int) -> DataFrame:
    """Mean days from a customer's first start to each start of the plan.

    Sums per customer are enough, so no row has to be joined with its first one."""
    wanted = F.col("plan_id") == plan
    day = F.unix_date("start_date").cast("bigint")
    sums = subs.groupBy("customer_id").agg(
        F.min(day).alias("first"), F.sum(F.when(wanted, day)).alias("days"), count_when(wanted).alias("n")
    )
    totals = sums.agg(F.sum(F.col("days") - F.col("first") * F.col("n")).alias("d"), F.sum("n").alias("n"))
    return totals.select(ratio(F.col("d"), F.col("n"), 0).alias("avg_days"))


def days_per_start(subs: DataFrame, plan: int) -> DataFrame:
    """(days since the customer's first start, number of starts of the plan)."""
    per_day = subs.groupBy("customer_id", "start_date").agg(count_when(F.col("plan_id") == plan).alias("n"))
    first = F.min("start_date").over(Window.partitionBy("customer_id"))
    days = per_day.withColumn("days", F.datediff("start_date", first)).filter(F.col("n") > 0)
    return days.groupBy("days").agg(F.sum("n").alias("n"))


def upgrade_bands(subs: DataFrame, plan: int, width: int) -> DataFrame:
    """Starts per band of days; the upper edge belongs to a band."""
    bands = days_per_start(subs, plan).withColumn("join_days_range", upper_inclusive_band(F.col("days"), width))
    return bands.groupBy("join_days_range").agg(F.sum("n").alias("number_of_customers"))


def upgrade_buckets(subs: DataFrame, plan: int, low: int, high: int, buckets: int) -> DataFrame:
    """Starts per equal-width bucket; the lower edge belongs to a bucket."""
    width = (high - low) // buckets
    counts = (
        days_per_start(subs, plan)
        .withColumn("bucket_number", F.width_bucket("days", F.lit(low), F.lit(high), F.lit(buckets)).cast("int"))
        .groupBy("bucket_number")
        .agg(F.sum("n").alias("number_of_customers"))
    )
    upper = F.col("bucket_number") * width + low
    label = F.concat((upper - width).cast("string"), F.lit(" - "), upper.cast("string"))
    return counts.withColumn("join_days_range", label)


def first_of_two(subs: DataFrame, high: int, low: int) -> DataFrame:
    """Customers whose first of the two plans is the higher one and who have more rows of them."""
    both = subs.filter(F.col("plan_id").isin(high, low))
    firsts = both.groupBy("customer_id").agg(
        F.min_by(F.struct("plan_id", "start_date"), F.struct(*ORDER)).alias("first"),
        F.count(F.lit(1)).alias("plan_changes"),
    )
    return firsts.filter((F.col("plan_changes") > 1) & (F.col("first.plan_id") == high)).select(
        "customer_id", F.col("first.start_date").alias("start_date"), "plan_changes"
    )


def later_pairs(subs: DataFrame, high: int, low: int) -> DataFrame:
    """Per customer: pairs of a higher plan and a lower one that starts on a later day.

    The pairs are counted, not built: every day of the lower plan meets the number
    of higher-plan starts before it."""
    is_high, is_low = F.col("plan_id") == high, F.col("plan_id") == low
    per_day = subs.groupBy("customer_id", "start_date").agg(
        count_when(is_high).alias("highs"), count_when(is_low).alias("lows")
    )
    earlier = Window.partitionBy("customer_id").orderBy("start_date").rowsBetween(Window.unboundedPreceding, -1)
    pairs = per_day.withColumn("pairs", F.coalesce(F.sum("highs").over(earlier), F.lit(0)) * F.col("lows"))
    return (
        pairs.groupBy("customer_id")
        .agg(
            F.min(F.when(F.col("highs") > 0, F.col("start_date"))).alias("first_high"),
            F.max(F.when(F.col("lows") > 0, F.col("start_date"))).alias("last_low"),
            F.sum("pairs").alias("pairs"),
        )
        .filter(F.col("pairs") > 0)
    )


def payments(subs: DataFrame, plans: DataFrame, year: int, monthly: str, annual: str) -> DataFrame:
    """Due date and amount of every paid plan start in a year.

    The price of the previous plan is credited, except when a monthly plan turns
    annual: then the full price falls due when the running month ends."""
    started = subs.filter(F.year("start_date") == year).join(plans, "plan_id")
    previous = {"prev_price": "price", "prev_plan": "plan_name", "prev_start": "start_date"}
    rows = shift_rows(started, ["customer_id"], ORDER, previous, by_day_and_id(), forward=False)
    deferred = (F.col("plan_name") == annual) & (F.col("prev_plan") == monthly)
    renewal = F.add_months("prev_start", calendar_months_between(F.col("prev_start"), F.col("start_date")))
    return rows.select(
        "customer_id",
        "event_id",
        "plan_name",
        F.when(deferred, renewal).otherwise(F.col("start_date")).alias("payment_due_date"),
        F.when(deferred, F.col("price")).otherwise(F.col("price") - F.col("prev_price")).alias("payment"),
    ).filter(F.col("payment").isNotNull())


def recurring_payments(subs: DataFrame, plans: DataFrame, last_day: str, monthly: Sequence[str]) -> DataFrame:
    """Every payment up to a day: monthly plans again on the same day of each month
    until the next plan starts, other priced plans once."""
    until = F.lit(last_day).cast("date")
    started = shift_rows(subs, ["customer_id"], ORDER, {"next_start": "start_date"}, by_day_and_id()).join(plans, "plan_id")
    priced = started.filter((F.col("price") > 0) & (F.col("start_date") <= until))
    end = F.least(until, F.coalesce(F.date_sub("next_start", 1), until))
    months = (F.year(end) - F.year("start_date")) * 12 + F.month(end) - F.month("start_date")
    steps = F.when(F.col("plan_name").isin(*monthly), F.greatest(months, F.lit(0))).otherwise(0)
    paid = priced.withColumn("_end", end).withColumn("step", F.explode(F.sequence(F.lit(0), steps)))
    paid = paid.withColumn("payment_date", F.add_months("start_date", F.col("step")))
    # the day of the last month may lie beyond the end: 30 January, 29 February, 30 March
    paid = paid.filter((F.col("step") == 0) | (F.col("payment_date") <= F.col("_end")))
    return paid.select("customer_id", "event_id", "plan_name", "payment_date", "price")
