from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from seeds import plans, subscriptions

from tallywork.operators import subscriptions as sb


@pytest.fixture(scope="module")
def subs(spark):
    return subscriptions(spark).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_churn(subs):
    assert rows(sb.churn_rate(subs, 4).selectExpr("churn_events", "churned_customers", "double(churn_percentage)")) == [(1, 1, 16.7)]
    assert rows(sb.second_plan_is(subs, 4)) == rows(sb.followed_by(subs, 0, 4))
    assert sb.second_plan_is(subs, 4).first().churned_customers == 1


def test_next_plans_and_mix(spark, subs):
    shares = sb.next_plan_share(subs, 0).selectExpr("plan_id", "converted_customers", "double(conversion_percentage)")
    assert rows(shares) == [(1, 2, 33.3), (2, 2, 33.3), (3, 1, 16.7), (4, 1, 16.7)]
    mix = sb.plan_mix_at(subs, plans(spark), "2020-12-31").select("plan_id", "customers")
    assert rows(mix) == [(1, 3), (3, 2), (4, 1)]


def test_days_and_bands(subs):
    # customer 3: 101 days, customer 5: 7 days
    assert int(sb.days_to_plan(subs, 3).first()[0]) == 54
    assert rows(sb.upgrade_bands(subs, 3, 30)) == [("0-30", 1), ("91-120", 1)]
    buckets = sb.upgrade_buckets(subs, 3, 0, 360, 12)
    assert rows(buckets.select("bucket_number", "join_days_range", "number_of_customers")) == [(1, "0 - 30", 1), (4, "90 - 120", 1)]


def test_band_edges(spark):
    days = spark.createDataFrame([(0,), (30,), (31,), (60,), (360,)], "days int")
    from tallywork.functions.numbers import upper_inclusive_band

    assert [r[0] for r in days.select(upper_inclusive_band(F.col("days"), 30)).collect()] == ["0-30", "0-30", "31-60", "31-60", "331-360"]
    wide = days.select(F.width_bucket("days", F.lit(0), F.lit(360), F.lit(12)))
    assert [r[0] for r in wide.collect()] == [1, 2, 2, 3, 13]


def test_downgrades_three_ways(subs):
    year = subs.filter(F.year("start_date") == 2020)
    assert [r.customer_id for r in sb.first_of_two(year, 2, 1).collect()] == [4]
    assert [(r.customer_id, r.pairs) for r in sb.later_pairs(year, 2, 1).collect()] == [(4, 1)]
    moves = sb.next_plans(year).filter("plan_id = 2 and next_plan_id = 1")
    assert [r.customer_id for r in moves.collect()] == [4]


def test_payments(spark, subs):
    paid = sb.payments(subs, plans(spark), 2020, "pro monthly", "pro annual")
    got = rows(paid.selectExpr("customer_id", "plan_name", "payment_due_date", "double(payment)"))
    d = dt.date
    assert got == [
        (1, "basic monthly", d(2020, 8, 8), 9.9),
        (3, "pro annual", d(2020, 4, 17), 199.0),
        (3, "pro monthly", d(2020, 1, 17), 19.9),
        (4, "basic monthly", d(2020, 6, 8), -10.0),
        (4, "pro monthly", d(2020, 5, 8), 19.9),
        (5, "pro annual", d(2020, 9, 27), 199.0),
        (6, "basic monthly", d(2020, 12, 22), 9.9),
    ]


def test_recurring_payments(spark, subs):
    paid = sb.recurring_payments(subs, plans(spark), "2020-12-31", ("basic monthly", "pro monthly"))
    counts = {r[0]: r[1] for r in paid.groupBy("customer_id").count().collect()}
    assert counts == {1: 5, 3: 5, 4: 8, 5: 1, 6: 1}


def test_recurring_payments_at_month_ends(spark):
    """The day of the month moves to the last one of a short month."""
    history = [(1, 1, 2, "2024-01-30"), (1, 2, 4, "2024-03-01"), (2, 3, 2, "2023-01-29"), (2, 4, 4, "2023-02-28"),
               (3, 5, 2, "2023-01-31"), (3, 6, 4, "2023-03-01"), (4, 7, 2, "2023-12-31")]
    subs = spark.createDataFrame(history, "customer_id int, event_id int, plan_id int, day string")
    subs = subs.withColumn("start_date", F.to_date("day")).drop("day")
    paid = sb.recurring_payments(subs, plans(spark), "2024-02-28", ("pro monthly",)).filter("plan_name = 'pro monthly'")
    got = sorted((r.customer_id, str(r.payment_date)) for r in paid.collect())
    assert got == [(1, "2024-01-30"), (2, "2023-01-29"), (3, "2023-01-31"), (3, "2023-02-28"), (4, "2023-12-31"), (4, "2024-01-31")]
    later = sb.recurring_payments(subs, plans(spark), "2024-12-31", ("pro monthly",)).filter("customer_id = 1")
    assert sorted(str(r.payment_date) for r in later.collect() if r.plan_name == "pro monthly") == ["2024-01-30", "2024-02-29"]
