from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from seeds import members, menu, sales

from tallywork.operators import aggregates as agg
from tallywork.operators import events as ev


@pytest.fixture(scope="module")
def bought(spark):
    return sales(spark).join(menu(spark), "product_id").cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_totals_and_visits(bought):
    assert rows(agg.total(bought, ["customer_id"], F.col("price"), "t")) == [("A", 76), ("B", 74), ("C", 36)]
    assert rows(agg.distinct_count(bought, ["customer_id"], "order_date")) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_items_keep_ties(bought):
    first = agg.top_per_group(bought, ["customer_id"], "order_date", descending=False)
    got = rows(first.select("customer_id", "product_name").distinct())
    assert got == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_top_and_favourite_items(bought):
    counts = agg.count_rows(bought, ["product_name"])
    assert rows(agg.top_k(counts, "n", 1, ["product_name"])) == [("ramen", 8)]
    per_customer = agg.count_rows(bought, ["customer_id", "product_name"])
    assert rows(agg.top_per_group(per_customer, ["customer_id"], "n")) == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3),
    ]


def test_around_the_join_date(spark, bought):
    args = (bought, members(spark), "customer_id", "order_date", "join_date")
    assert rows(ev.first_after(*args).select("customer_id", "product_name")) == [("A", "ramen"), ("B", "sushi")]
    last = ev.last_before(*args, ["product_id"]).select("customer_id", "product_name")
    assert rows(last) == [("A", "curry"), ("B", "sushi")]  # A has two items that day; the higher id wins
    before = ev.before_event(*args).groupBy("customer_id").agg(F.count(F.lit(1)), F.sum("price"))
    assert rows(before) == [("A", 2, 25), ("B", 3, 40)]


def test_points(spark, bought):
    sushi = F.col("product_name") == "sushi"
    assert rows(agg.total(bought, ["customer_id"], ev.tiered(sushi, F.col("price"), 10, 2), "p")) == [
        ("A", 860), ("B", 940), ("C", 360),
    ]
    january = bought.join(members(spark), "customer_id").filter(
        (F.trunc("order_date", "MM") == "2021-01-01") & (F.col("order_date") >= F.col("join_date"))
    )
    promo = sushi | F.col("order_date").between(F.col("join_date"), F.date_add("join_date", 6))
    assert rows(agg.total(january, ["customer_id"], ev.tiered(promo, F.col("price"), 10, 2), "p")) == [("A", 1020), ("B", 320)]


def test_flags_and_masked_rank(spark, bought):
    flagged = ev.event_flag(bought, members(spark), "customer_id", "order_date", "join_date")
    ranked = ev.masked_rank(flagged, ["customer_id"], "member", "order_date", "ranking")
    got = sorted(
        ((r.customer_id, str(r.order_date), r.product_name, r.member, r.ranking) for r in ranked.collect()), key=str
    )
    assert [g[3:] for g in got if g[0] == "A"] == [("N", None), ("N", None), ("Y", 1), ("Y", 2), ("Y", 3), ("Y", 3)]
    assert [g[3:] for g in got if g[0] == "B"] == [("N", None)] * 3 + [("Y", 1), ("Y", 2), ("Y", 3)]
    assert [g[3:] for g in got if g[0] == "C"] == [("N", None)] * 3


def test_empty_input(bought):
    nothing = bought.filter(F.lit(False))
    assert rows(agg.top_per_group(nothing, ["customer_id"], "order_date")) == []
    assert rows(agg.total(nothing, [], F.col("price"), "t")) == [(None,)]
