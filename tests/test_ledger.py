from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from seeds import day, transactions

from tallywork.operators import ledger as lg

ENDS = ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"]


@pytest.fixture(scope="module")
def closing(spark):
    return lg.closing_balance(transactions(spark)).cache()


def per_customer(df, column):
    out = {}
    for r in df.orderBy("customer_id", "month_end").collect():
        out.setdefault(r.customer_id, []).append(None if r[column] is None else int(r[column]))
    return out


def test_closing_balance(closing):
    assert per_customer(closing, "total_month_change") == {1: [312, 0, -952, 0], 2: [549, 0, 61, 0], 3: [144, -965, -401, 493]}
    assert per_customer(closing, "closing_balance") == {
        1: [312, 312, -640, -640], 2: [549, 549, 610, 610], 3: [144, -821, -1222, -729],
    }
    assert [str(r[0]) for r in closing.filter("customer_id = 1").orderBy("month_end").select("month_end").collect()] == ENDS


def test_percent_change(closing):
    assert per_customer(lg.balance_change(closing), "percent_change") == {
        1: [None, 0, -305, 0], 2: [None, 0, 11, 0], 3: [None, -670, 49, -40],
    }


def test_growing_customers(closing):
    assert float(lg.growing_customers(closing, 5).first()[0]) == pytest.approx(0.6667)


def test_zero_balance_gives_no_growth(spark):
    rows = [(1, day("2020-01-05"), "deposit", 10), (1, day("2020-01-06"), "purchase", 10), (1, day("2020-02-01"), "deposit", 5)]
    txns = spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int")
    changes = lg.balance_change(lg.closing_balance(txns))
    assert per_customer(changes, "percent_change") == {1: [None, None]}


def test_stated_months(spark):
    """Months outside do not count, and every customer keeps its rows."""
    got = per_customer(lg.closing_balance(transactions(spark), "2020-02-01", "2020-03-01"), "closing_balance")
    assert got == {1: [0, -952], 2: [0, 61], 3: [-965, -1366]}


def test_running_balance_and_stats(spark):
    txns = transactions(spark)
    got = lg.running_balance(txns).filter("customer_id = 3").orderBy("txn_date")
    assert [int(r.running_total_balance) for r in got.collect()] == [144, -821, -1034, -1222, -729]
    stats = {r[0]: tuple(int(x) for x in r[1:]) for r in lg.balance_stats(txns).collect()}
    assert stats[2] == (549, 610, 580)
    assert stats[3] == (-1222, 144, -732)


def test_same_day_rows_share_the_balance(spark):
    rows = [(1, day("2020-01-05"), "deposit", 10), (1, day("2020-01-05"), "purchase", 4), (1, day("2020-01-07"), "deposit", 1)]
    txns = spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int")
    assert sorted(int(r.running_total_balance) for r in lg.running_balance(txns).collect()) == [6, 6, 7]


def test_sizes(spark, closing):
    changed = closing.filter(F.col("total_month_change") != 0)
    got = lg.sizes(changed, {"bytes": "closing_balance"}).first()
    assert (got.number_of_rows, got.bytes) == (8, 64)
    texts = spark.createDataFrame([("ab",), (None,), ("é",)], "t string")
    assert tuple(lg.sizes(texts, {"b": "t"}).first()) == (3, 4)
