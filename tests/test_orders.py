from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from seeds import customer_orders, pizza_names, pizza_recipes, pizza_toppings, runner_orders

from tallywork.functions import dates as d
from tallywork.functions import text as tx
from tallywork.operators import aggregates as agg
from tallywork.operators import cleaning as cl
from tallywork.operators import deliveries as dl
from tallywork.operators import recipes as rc


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    return cl.clean_order_items(customer_orders(spark)).cache()


@pytest.fixture(scope="module")
def deliveries(spark):
    return cl.clean_deliveries(runner_orders(spark)).cache()


@pytest.fixture(scope="module")
def delivered(items, deliveries):
    return items.join(deliveries.filter(dl.delivered()), "order_id").cache()


def test_cleaned_items(items):
    got = {(r.order_id, r.order_item_id): (r.pizza_id, r.exclusions, r.extras) for r in items.collect()}
    assert len(got) == 14
    assert got[(9, 1)] == (1, "4", "1,5")
    assert got[(10, 1)] == (1, None, None) and got[(10, 2)] == (1, "2,6", "1,4")
    assert got[(4, 1)] == got[(4, 2)] == (1, "4", None)


def test_changes_and_zipped_lists(items):
    assert cl.order_changes(items).count() == 6 + 6
    zipped = cl.zip_lists(items).filter("order_id in (9, 4)")
    assert rows(zipped.select("order_id", "order_item_id", "change_index", "exclusion_id", "extras_id")) == [
        (4, 1, 1, "4", None), (4, 2, 1, "4", None), (4, 3, 1, "4", None), (9, 1, 1, "4", "1"), (9, 1, 2, "", "5"),
    ]


def test_cleaned_deliveries(deliveries):
    got = {r.order_id: (r.distance, r.duration, r.cancellation) for r in deliveries.collect()}
    assert got[1] == (20.0, 32.0, None) and got[8] == (23.4, 15.0, None) and got[3] == (13.4, 20.0, None)
    assert got[6] == (None, None, "Restaurant Cancellation")


def test_delivery_counts(spark, items, deliveries, delivered):
    assert rows(agg.count_rows(deliveries.filter(dl.not_cancelled()), ["runner_id"])) == [(1, 4), (2, 3), (3, 1)]
    kinds = delivered.join(pizza_names(spark), "pizza_id")
    assert rows(agg.count_rows(kinds, ["pizza_name"])) == [("Meatlovers", 9), ("Vegetarian", 3)]
    ordered = items.join(pizza_names(spark), "pizza_id")
    assert rows(agg.count_rows(ordered, ["customer_id", "pizza_name"])) == [
        (101, "Meatlovers", 2), (101, "Vegetarian", 1), (102, "Meatlovers", 2), (102, "Vegetarian", 1),
        (103, "Meatlovers", 3), (103, "Vegetarian", 1), (104, "Meatlovers", 3), (105, "Vegetarian", 1),
    ]
    assert delivered.groupBy("order_id").count().agg(F.max("count")).first()[0] == 3
    both = delivered.filter("exclusions is not null and extras is not null")
    assert both.count() == 1
    assert rows(dl.success_percent(deliveries).selectExpr("runner_id", "int(percentage_successful)")) == [(1, 100), (2, 75), (3, 50)]


def test_hours_weekdays_and_weeks(spark, items):
    hours = dict(rows(agg.count_rows(items.withColumn("h", F.hour("order_time")), ["h"])))
    assert hours == {11: 1, 13: 3, 18: 3, 19: 1, 21: 3, 23: 3}
    days = dict(rows(agg.count_rows(items.withColumn("w", d.weekday_name(F.col("order_time"))), ["w"])))
    assert days == {"Wednesday": 5, "Saturday": 5, "Thursday": 3, "Friday": 1}
    runners = spark.sql("select * from values (1,date'2021-01-01'),(2,date'2021-01-03'),(3,date'2021-01-08'),(4,date'2021-01-15') as t(r, day)")
    assert rows(agg.count_rows(runners.withColumn("w", d.weeks_from(F.col("day"), "2021-01-01")), ["w"])) == [(1, 2), (2, 1), (3, 1)]


def test_waits_and_speeds(items, deliveries):
    counts = items.groupBy("order_id", "customer_id", "order_time").agg(F.count(F.lit(1)).alias("items"))
    waiting = dl.waits(counts, deliveries)
    assert rows(dl.avg_wait_by_runner(waiting).selectExpr("runner_id", "int(pickup_minutes)")) == [(1, 16), (2, 24), (3, 10)]
    # Whole minutes (10, 10, 21, 29, 10, 10, 20, 15) would give 15; minute marks crossed are one more for most.
    assert dl.avg_wait_overall(waiting).first()[0] == 16
    assert rows(dl.prep_time_by_size(waiting).selectExpr("number_of_items", "double(avg_minutes)")) == [(1, 12.2), (2, 18.5), (3, 29.0)]
    speeds = dict(rows(deliveries.filter(dl.delivered()).select("order_id", dl.speed_kmh().cast("double"))))
    assert speeds[1] == 37.5 and speeds[10] == 60.0 and speeds[4] == 35.1 and speeds[8] == 93.6 and speeds[5] == 40.0
    distances = dict(rows(dl.avg_distance(counts, deliveries).selectExpr("customer_id", "double(avg_distance)")))
    assert distances[104] == 10.0 and distances[105] == 25.0
    assert deliveries.agg(F.max("duration") - F.min("duration")).first()[0] == 30.0


def test_recipes(spark):
    recipe = cl.recipe_rows(pizza_recipes(spark))
    assert rows(rc.shared_members(recipe.withColumn("p", F.col("pizza_id").cast("string")), "p", "topping_id", "1", "2")) == [(4,), (6,)]
    usage = agg.count_rows(recipe, ["topping_id"])
    assert dict(rows(usage))[4] == 2 and usage.count() == 12


def test_labels_and_ingredients(spark, items):
    labels = rc.item_labels(items, pizza_names(spark), pizza_toppings(spark))
    text = {(r.order_id, r.order_item_id): r.order_string for r in labels.collect()}
    assert len(text) == 14
    assert text[(1, 1)] == "Meatlovers"
    assert text[(4, 3)] == "Vegetarian - Exclude: Cheese"
    assert text[(9, 1)] == "Meatlovers - Exclude: Cheese - Extra: Bacon, Chicken"
    assert text[(10, 2)] == "Meatlovers - Exclude: BBQ Sauce, Mushrooms - Extra: Bacon, Cheese"
    lists = rc.ingredient_lists(items, pizza_recipes(spark), pizza_names(spark), pizza_toppings(spark))
    got = {(r.order_id, r.order_item_id): r.ingredients for r in lists.collect()}
    assert len(got) == 14
    assert got[(10, 2)] == "2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami"
    assert got[(7, 1)] == "Bacon, Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"


def test_repeated_and_missing_topping_ids(spark):
    items = spark.createDataFrame([(1, 1, 7, "2", "3,9"), (1, 2, 7, None, None), (2, 1, None, "2", None)], "order_id int, order_item_id int, pizza_id int, exclusions string, extras string")
    names = spark.createDataFrame([(7, "Seven")], "pizza_id int, pizza_name string")
    recipes = spark.createDataFrame([(7, "2, 3")], "pizza_id int, toppings string")
    toppings = spark.createDataFrame([(2, "B"), (2, "BB"), (3, "C"), (None, "N")], "topping_id int, topping_name string")
    labels = rows(rc.item_labels(items, names, toppings))
    assert labels == [(1, 1, "Seven - Exclude: B, BB - Extra: C"), (1, 2, "Seven")]
    lists = rows(rc.ingredient_lists(items, recipes, names, toppings))
    assert lists == [(1, 1, "Seven", "2xC"), (1, 2, "Seven", "B, BB, C")]
    assert rows(rc.ingredient_totals(items, recipes, toppings)) == [("B", 1), ("BB", 1), ("C", 3)]


def test_item_numbers_with_missing_products(spark):
    raw = spark.createDataFrame([(1, p, "", "null") for p in (10, None, 1, 200001, 10)], "order_id int, pizza_id int, exclusions string, extras string")
    numbered = sorted((r.order_item_id, r.pizza_id) for r in cl.clean_order_items(raw).collect())
    assert numbered == [(1, 1), (2, 10), (3, 10), (4, 200001), (5, None)]


def test_quantities_and_prices(spark, items, deliveries, delivered):
    totals = dict(rows(rc.ingredient_totals(delivered, pizza_recipes(spark), pizza_toppings(spark))))
    assert totals["Bacon"] == 12 and totals["Mushrooms"] == 11 and totals["Cheese"] == 10 and totals["Onions"] == 3
    priced = items.join(pizza_names(spark), "pizza_id")
    base = priced.agg(F.sum("price")).first()[0]
    assert base == 160.0
    assert rc.extras_charge(items, pizza_toppings(spark), "Cheese", 2, 1).first()[0] == 7
    orders = priced.groupBy("order_id").agg(F.sum("price").cast("decimal(18,2)").alias("order_total"))
    assert float(dl.profit(orders, deliveries, "0.30").first()[0]) == pytest.approx(94.44)


def test_extended_menu(spark):
    names = pizza_names(spark).withColumn("pizza_id", F.col("pizza_id").cast("bigint"))
    recipe = cl.recipe_rows(pizza_recipes(spark)).withColumn("pizza_id", F.col("pizza_id").cast("bigint"))
    menu, more = rc.add_product(names, recipe, pizza_toppings(spark), 3, "Supreme", 15.0)
    assert (3, "Supreme", 15.0) in rows(menu)
    assert dict(rows(agg.count_rows(more, ["pizza_id"])))[3] == 12


def test_list_edges(spark):
    cells = spark.createDataFrame([(None,), ("",), (" ",), ("null",), ("7",), ("10, 11",), ("1,12,3",)], "c string")
    cleaned = tx.clean_list(F.col("c"))
    got = [tuple(r) for r in cells.select(cleaned, tx.list_size(cleaned), tx.list_ids(cleaned)).collect()]
    assert got[:4] == [(None, None, [])] * 4
    assert got[4:] == [("7", 1, [7]), ("10,11", 2, [10, 11]), ("1,12,3", 3, [1, 12, 3])]
