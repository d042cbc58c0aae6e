"""Small tables typed by hand."""

from __future__ import annotations

import datetime as dt


def day(text):
    return dt.date.fromisoformat(text)


def sales(spark):
    bought = {
        "A": [("2021-01-01", 1), ("2021-01-01", 2), ("2021-01-07", 2), ("2021-01-10", 3), ("2021-01-11", 3), ("2021-01-11", 3)],
        "B": [("2021-01-01", 2), ("2021-01-02", 2), ("2021-01-04", 1), ("2021-01-11", 1), ("2021-01-16", 3), ("2021-02-01", 3)],
        "C": [("2021-01-01", 3), ("2021-01-01", 3), ("2021-01-07", 3)],
    }
    rows = [(c, day(d), p) for c, lines in bought.items() for d, p in lines]
    return spark.createDataFrame(rows, "customer_id string, order_date date, product_id int")


def menu(spark):
    return spark.createDataFrame(
        [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)], "product_id int, product_name string, price int"
    )


def members(spark):
    return spark.createDataFrame([("A", day("2021-01-07")), ("B", day("2021-01-09"))], "customer_id string, join_date date")


def customer_orders(spark):
    rows = [
        (1, 101, 1, "", "", "2020-01-01 18:05:02"),
        (2, 101, 1, "", "", "2020-01-01 19:00:52"),
        (3, 102, 1, "", "", "2020-01-02 23:51:23"),
        (3, 102, 2, "", None, "2020-01-02 23:51:23"),
        (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
        (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
        (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
        (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
        (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
        (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
        (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
        (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
        (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
        (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
    ]
    schema = "order_id int, customer_id int, pizza_id int, exclusions string, extras string, t string"
    return spark.createDataFrame(rows, schema).selectExpr("* except (t)", "cast(t as timestamp_ntz) as order_time")


def runner_orders(spark):
    rows = [
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
        (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
        (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
        (5, 3, "2020-01-08 21:10:57", "10", "15", None),
        (6, 3, "null", "null", "null", "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
        (9, 2, "null", "null", "null", "Customer Cancellation"),
        (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
    ]
    schema = "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string"
    return spark.createDataFrame(rows, schema)


def pizza_names(spark):
    return spark.createDataFrame(
        [(1, "Meatlovers", 12.0), (2, "Vegetarian", 10.0)], "pizza_id int, pizza_name string, price double"
    )


def pizza_recipes(spark):
    return spark.createDataFrame(
        [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")], "pizza_id int, toppings string"
    )


def pizza_toppings(spark):
    names = ["Bacon", "BBQ Sauce", "Beef", "Cheese", "Chicken", "Mushrooms", "Onions", "Pepperoni", "Peppers", "Salami",
             "Tomatoes", "Tomato Sauce"]
    return spark.createDataFrame(list(enumerate(names, 1)), "topping_id int, topping_name string")


def plans(spark):
    rows = [(0, "trial", "0"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"), (3, "pro annual", "199"), (4, "churn", None)]
    raw = spark.createDataFrame(rows, "plan_id int, plan_name string, p string")
    return raw.selectExpr("plan_id", "plan_name", "cast(p as decimal(5,2)) as price")


def subscriptions(spark):
    """Histories: stays on basic; churns after the trial; pro then annual; pro then basic; straight to annual."""
    histories = {
        1: [(0, "2020-08-01"), (1, "2020-08-08")],
        2: [(0, "2020-03-17"), (4, "2020-03-24")],
        3: [(0, "2020-01-10"), (2, "2020-01-17"), (3, "2020-04-20")],
        4: [(0, "2020-05-01"), (2, "2020-05-08"), (1, "2020-06-08")],
        5: [(0, "2020-09-20"), (3, "2020-09-27")],
        6: [(0, "2020-12-15"), (1, "2020-12-22"), (2, "2021-03-29")],
    }
    rows = [(c, 10 * c + i, day(d), p) for c, h in histories.items() for i, (p, d) in enumerate(h)]
    return spark.createDataFrame(rows, "customer_id int, event_id int, start_date date, plan_id int")


def transactions(spark):
    rows = [
        (1, "2020-01-02", "deposit", 312), (1, "2020-03-05", "deposit", 324), (1, "2020-03-17", "purchase", 664),
        (1, "2020-03-19", "withdrawal", 612),
        (2, "2020-01-03", "deposit", 549), (2, "2020-03-24", "deposit", 61),
        (3, "2020-01-27", "deposit", 144), (3, "2020-02-22", "purchase", 965), (3, "2020-03-05", "withdrawal", 213),
        (3, "2020-03-19", "withdrawal", 188), (3, "2020-04-12", "deposit", 493),
    ]
    schema = "customer_id int, txn_date date, txn_type string, txn_amount int"
    return spark.createDataFrame([(c, day(d), t, a) for c, d, t, a in rows], schema)
