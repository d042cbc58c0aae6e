"""Accounts: signed amounts, month spines, closing and running balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.dates import days_span, month_start
from tallywork.functions.numbers import logical_size, percent, ratio
from tallywork.operators.skew import running_series, running_total

BALANCE = "decimal(18,2)"


def signed(kind: str = "txn_type", amount: str = "txn_amount") -> Column:
    """Deposits in, purchases and withdrawals out; NULL for other kinds."""
    return F.when(F.col(kind) == "deposit", F.col(amount)).when(
        F.col(kind).isin("purchase", "withdrawal"), -F.col(amount)
    )


def closing_balance(txns: DataFrame, first_month: str | None = None, last_month: str | None = None) -> DataFrame:
    """Month-end balance of every customer for every month from the first to the last.

    Months without a transaction are filled from the row before them, so no grid of
    customers and months has to be built and joined. Without given months the span
    of the data is used; transactions outside of given months do not count."""
    month = month_start(F.col("txn_date"))
    span = txns.agg(F.struct(F.min(month).alias("lo"), F.max(month).alias("hi"))).scalar()
    low = span["lo"] if first_month is None else F.lit(first_month).cast("date")
    high = span["hi"] if last_month is None else F.lit(last_month).cast("date")
    inside = F.lit(True)
    if first_month is not None:
        inside = inside & (month >= low)
    if last_month is not None:
        inside = inside & (month <= high)
    monthly = txns.groupBy("customer_id", F.when(inside, month).otherwise(low).alias("month")).agg(
        F.coalesce(F.sum(F.when(inside, signed())), F.lit(0)).cast(BALANCE).alias("change")
    )
    months = Window.partitionBy("customer_id").orderBy("month")
    filled = monthly.select(
        "customer_id",
        "month",
        "change",
        F.sum("change").over(months).cast(BALANCE).alias("balance"),
        F.when(F.lag("month").over(months).isNull(), low).otherwise(F.col("month")).alias("_from"),
        F.coalesce(F.add_months(F.lead("month").over(months), -1), high).alias("_to"),
    )
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    spine = filled.withColumn("_month", F.explode(F.sequence("_from", "_to", step)))
    zero = F.lit(0).cast(BALANCE)
    return spine.select(
        "customer_id",
        F.last_day("_month").alias("month_end"),
        F.when(F.col("_month") == F.col("month"), F.col("change")).otherwise(zero).alias("total_month_change"),
        F.when(F.col("_month") < F.col("month"), zero).otherwise(F.col("balance")).alias("closing_balance"),
    )


def balance_change(closing: DataFrame) -> DataFrame:
    """Change on the month before in whole percent; NULL after a zero balance.

    A negative balance before turns the sign around: -821 to -1222 is +49 %."""
    before = F.lag("closing_balance").over(Window.partitionBy("customer_id").orderBy("month_end"))
    return closing.withColumn("percent_change", percent(F.col("total_month_change"), before, 0))


def growing_customers(closing: DataFrame, at_least: int) -> DataFrame:
    """Share of customers with a month that grew by at least so many percent."""
    best = balance_change(closing).groupBy("customer_id").agg(F.max("percent_change").alias("best"))
    counts = best.agg(F.count(F.when(F.col("best") >= at_least, 1)).alias("up"), F.count(F.lit(1)).alias("n"))
    return counts.select(ratio(F.col("up"), F.col("n"), 4).alias("percent_customers_with_balance_growth"))


def running_balance(txns: DataFrame) -> DataFrame:
    """Balance after each transaction; those of one day share it."""
    return running_total(txns, ["customer_id"], "txn_date", signed(), "running_total_balance")


def daily_balance(txns: DataFrame) -> DataFrame:
    """Balance per customer and transaction day, with the number of transactions."""
    series = running_series(txns, ["customer_id"], "txn_date", signed(), "balance")
    return series.withColumn("balance", F.col("balance").cast(BALANCE))


def balance_stats(txns: DataFrame) -> DataFrame:
    """Smallest, largest and mean running balance per customer."""
    sums = daily_balance(txns).groupBy("customer_id").agg(
        F.min("balance").alias("min_balance"),
        F.max("balance").alias("max_balance"),
        F.sum(F.col("balance") * F.col("rows")).alias("s"),
        F.sum("rows").alias("n"),
    )
    return sums.select("customer_id", "min_balance", "max_balance", ratio(F.col("s"), F.col("n"), 0).alias("avg_balance"))


def sizes(df: DataFrame, columns: dict[str, str], weight: Column | None = None) -> DataFrame:
    """One row: number of rows, and the bytes of each column (new name -> column)."""
    kinds = dict(df.dtypes)
    weight = F.lit(1) if weight is None else weight
    bytes_of = [F.sum(logical_size(F.col(c), kinds[c]) * weight).cast("bigint").alias(n) for n, c in columns.items()]
    return df.agg(F.sum(weight).cast("bigint").alias("number_of_rows"), *bytes_of)


def balance_spans(txns: DataFrame) -> DataFrame:
    """How long each balance held: from its day to the day before the next, or to the
    end of the last month of the data."""
    last = txns.agg(F.last_day(F.max("txn_date"))).scalar()
    following = F.lead("txn_date").over(Window.partitionBy("customer_id").orderBy("txn_date"))
    return daily_balance(txns).select(
        "customer_id", "balance", F.col("txn_date").alias("first_day"), F.coalesce(F.date_sub(following, 1), last).alias("last_day")
    )


def simple_interest(txns: DataFrame, rate: str) -> DataFrame:
    """Interest per month on each day's balance, without interest on interest."""
    spans = balance_spans(txns)
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    months = spans.withColumn(
        "month", F.explode(F.sequence(F.trunc("first_day", "MM"), F.trunc("last_day", "MM"), step))
    )
    days = days_span(F.greatest("first_day", "month"), F.least("last_day", F.last_day("month")))
    sums = months.groupBy("month").agg(F.sum(F.col("balance") * days).alias("balance_days"))
    yearly = F.col("balance_days").cast("decimal(28,2)") * F.lit(rate).cast("decimal(4,2)")
    return sums.select("month", ratio(yearly, F.lit(365), 2).alias("interest"))


def compound_interest(txns: DataFrame, rate: float, base: str) -> DataFrame:
    """Balance at each month end when interest is added every day, for every month from a
    customer's first transaction to the last month of the data.

    Every amount grows from its own day on, so a month end is a sum of amounts discounted to one
    base day, grown again to that month end. Factors are decimals, so the sum has one value in
    whatever order it is made."""
    daily = 1 + rate / 365
    last = txns.agg(F.max(month_start(F.col("txn_date")))).scalar()
    to_base = F.datediff(F.lit(base).cast("date"), F.col("txn_date"))
    factor = F.pow(F.lit(daily), to_base).cast("decimal(19,17)")
    per_month = txns.groupBy("customer_id", month_start(F.col("txn_date")).alias("month")).agg(
        F.sum(signed().cast("decimal(16,2)") * factor).alias("_discounted")
    )
    months = Window.partitionBy("customer_id").orderBy("month")
    sums = per_month.withColumns(
        {"_sum": F.sum("_discounted").over(months), "_to": F.coalesce(F.add_months(F.lead("month").over(months), -1), last)}
    )
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    spine = sums.withColumn("_month", F.explode(F.sequence("month", "_to", step))).withColumn("month_end", F.last_day("_month"))
    grown = F.col("_sum").cast("double") * F.pow(F.lit(daily), F.datediff(F.col("month_end"), F.lit(base).cast("date")))
    return spine.select("customer_id", "month_end", F.round(grown, 2).alias("balance_with_interest"))
