"""Business views over the star-schema tables: the inputs of the registered queries.

Each function takes (spark, folder) and returns a DataFrame; columns that a query
does not use are pruned down to the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.numbers import money
from tallywork.operators.skew import shift_rows
from tallywork.sources.tables import load

OPEN_END = "9999-12-31"
MEMBER_MIN_ORDERS = 12


def _text(col: Column) -> Column:
    return col.cast("string")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases: one row per line, with the buyer and the day of its order."""
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("l_orderkey").alias("txn_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        money(F.col("l_extendedprice")).alias("price"),
        money(F.col("l_discount")).alias("discount"),
        F.col("l_returnflag").alias("flag"),
    )


def basket_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as of study 7, which asks neither for the buyer nor for the day."""
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("txn_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        money(F.col("l_extendedprice")).alias("price"),
        money(F.col("l_discount")).alias("discount"),
        F.col("l_returnflag").alias("flag"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("segment_name"),
        F.col("p_type").alias("category_name"),
        money(F.col("p_retailprice")).alias("price"),
    )


def buyers(spark: SparkSession, folder: str) -> DataFrame:
    """The buyer of every order: as narrow a table as shows who buys most."""
    return load(spark, folder, "orders").select(F.col("o_custkey").alias("customer_id"))


def members(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent buyers; they join one year after their first order."""
    return (
        load(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.to_date(F.min("o_orderdate")).alias("first_day"))
        .filter(F.col("n") >= MEMBER_MIN_ORDERS)
        .select("customer_id", F.date_add("first_day", 365).alias("join_date"))
    )


def plans(spark: SparkSession, folder: str) -> DataFrame:
    """Subscription plans; the event types stand in for them."""
    return spark.sql(
        "select plan_id, plan_name, cast(price as decimal(5,2)) as price from values "
        "(0,'signup',0),(1,'view',9.90),(2,'click',19.90),(3,'purchase',199),(4,'error',null) "
        "as t(plan_id, plan_name, price)"
    )


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    plan_id = F.when(kind == "signup", 0).when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3)
    return load(spark, folder, "events").select(
        F.col("user_id").alias("customer_id"),
        "event_id",
        F.to_date("ts").alias("start_date"),
        plan_id.otherwise(4).alias("plan_id"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("txn_date"),
        F.when(status == "F", "deposit").when(status == "O", "purchase").otherwise("withdrawal").alias("txn_type"),
        money(F.col("o_totalprice")).alias("txn_amount"),
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
    )


def customer_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Stays on a node: from one order to the next, the last one open."""
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("start_date"),
    )
    stays = shift_rows(
        orders,
        keys=["customer_id"],
        order=["start_date", "order_id"],
        values={"next_start": "start_date"},
        slices=[F.col("start_date")],
    )
    customers, nations = load(spark, folder, "customer"), load(spark, folder, "nation")
    homes = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        "c_custkey", F.col("n_regionkey").alias("region_id")
    )
    return stays.join(homes, stays.customer_id == homes.c_custkey).select(
        "customer_id",
        "region_id",
        (F.col("order_id") % 5 + 1).cast("int").alias("node_id"),
        "start_date",
        F.coalesce("next_start", F.lit(OPEN_END).cast("date")).alias("end_date"),
    )


def weekly_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Raw weekly sales: text dates d/m/yy and the text 'null' in ``segment``."""
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    customers, nations, regions_ = (load(spark, folder, t) for t in ("customer", "nation", "region"))
    band = F.col("l_linenumber") % 5
    letter = F.when(F.col("l_returnflag") == "A", "C").otherwise("F")
    homes = (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        .join(regions_, nations.n_regionkey == regions_.r_regionkey)
        .select("c_custkey", "c_mktsegment", "r_name")
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(homes, orders.o_custkey == homes.c_custkey)
    return joined.select(
        F.date_format("o_orderdate", "d/M/yy").alias("week_date"),
        F.col("r_name").alias("region"),
        F.when(F.col("l_linestatus") == "F", "Retail").otherwise("Shopify").alias("platform"),
        F.when(band == 0, "null").otherwise(F.concat(letter, _text(band))).alias("segment"),
        F.col("c_mktsegment").alias("customer_type"),
        F.col("l_quantity").cast("int").alias("transactions"),
        money(F.col("l_extendedprice")).alias("sales"),
    )


def product_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Adjacency list region > nation > supplier."""
    top = load(spark, folder, "region").select(
        (F.col("r_regionkey") + 1000).cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.col("r_name").alias("level_text"),
    )
    middle = load(spark, folder, "nation").select(
        (F.col("n_nationkey") + 2000).cast("bigint").alias("id"),
        (F.col("n_regionkey") + 1000).cast("bigint").alias("parent_id"),
        F.col("n_name").alias("level_text"),
    )
    leaf = load(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 10000).alias("id"),
        (F.col("s_nationkey") + 2000).cast("bigint").alias("parent_id"),
        F.col("s_name").alias("level_text"),
    )
    return top.unionByName(middle).unionByName(leaf)


def product_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of the leaves; suppliers in debt have none."""
    return (
        load(spark, folder, "supplier")
        .filter(F.col("s_acctbal") >= 0)
        .select(
            (F.col("s_suppkey") + 10000).alias("id"),
            F.concat(F.lit("P"), _text(F.col("s_suppkey"))).alias("product_id"),
            money(F.col("s_acctbal")).alias("price"),
        )
    )


def runner_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw deliveries, one per order: units in text and mixed tokens for NULL."""
    key = F.col("o_orderkey")
    minutes, km = key % 50 + 10, _text(key % 40 + 5)
    pickup = F.col("o_orderdate") + F.make_dt_interval(mins=minutes.cast("int"), secs=(key % 60).cast("decimal(18,6)"))
    mins = _text(minutes)
    return load(spark, folder, "orders").select(
        key.alias("order_id"),
        (F.col("o_custkey") % 10).alias("runner_id"),
        F.when(key % 4 == 0, "null").otherwise(F.date_format(pickup, "yyyy-MM-dd HH:mm:ss")).alias("pickup_time"),
        F.when(key % 4 == 0, "null")
        .when(key % 4 == 1, F.concat(km, F.lit("km")))
        .when(key % 4 == 2, F.concat(km, F.lit(" km")))
        .otherwise(km)
        .alias("distance"),
        F.when(key % 5 == 0, "null")
        .when(key % 5 == 1, F.concat(mins, F.lit(" minutes")))
        .when(key % 5 == 2, F.concat(mins, F.lit("mins")))
        .when(key % 5 == 3, F.concat(mins, F.lit(" minute")))
        .otherwise(mins)
        .alias("duration"),
        F.when(key % 4 == 0, "Customer Cancellation")
        .when(key % 4 == 1, "")
        .when(key % 4 == 2, "null")
        .alias("cancellation"),
    )


def _topping_text(*ids: Column) -> Column:
    return F.concat_ws(", ", *[_text(i % 25 + 1) for i in ids])


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw order items with two lists of topping ids in text cells."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    pick = (part + F.col("l_linenumber")) % 5
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        part.alias("pizza_id"),
        F.when(pick == 0, "null")
        .when(pick == 1, "")
        .when(pick == 2, _topping_text(part))
        .when(pick == 3, _topping_text(part, part + 7))
        .alias("exclusions"),
        F.when(supp % 4 == 0, "null")
        .when(supp % 4 == 1, "")
        .when(supp % 4 == 2, _topping_text(supp))
        .otherwise(_topping_text(supp, supp + 3, supp + 11))
        .alias("extras"),
    )


def order_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Buyer and time of every order."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_time"),
    )


def pizza_names(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("pizza_id"),
        F.col("p_name").alias("pizza_name"),
        F.col("p_brand").alias("family"),
        money(F.col("p_retailprice")).alias("price"),
    )


def pizza_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Recipe per product: a text list of topping ids."""
    part, size = F.col("p_partkey"), F.col("p_size")
    return load(spark, folder, "part").select(
        part.alias("pizza_id"),
        F.col("p_brand").alias("family"),
        _topping_text(part, part + 1 + size % 5, part + 7, part + 12 + size % 3).alias("toppings"),
    )


def pizza_toppings(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "nation").select(
        (F.col("n_nationkey") + 1).alias("topping_id"), F.col("n_name").alias("topping_name")
    )


def signups(spark: SparkSession, folder: str) -> DataFrame:
    """Registration day of every buyer: the day of the first order."""
    return (
        load(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("runner_id"))
        .agg(F.to_date(F.min("o_orderdate")).alias("registration_date"))
    )


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(F.col("event_id").alias("order_id"), F.col("ts").alias("order_time"))


def interest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly figures per interest; the month is text and sometimes missing."""
    month = F.when(F.col("l_linenumber") != 7, F.date_format("l_shipdate", "MM-yyyy"))
    return (
        load(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("interest_id"), month.alias("month_year"))
        .agg(
            F.sum(money(F.col("l_quantity"))).alias("composition"),
            F.sum(money(F.col("l_tax"))).alias("tax"),
            F.count(F.lit(1)).cast("int").alias("ranking"),
            F.max(money(F.col("l_discount"))).alias("discount"),
        )
        .select(
            "interest_id",
            "month_year",
            "composition",
            (F.col("tax") + 1).alias("index_value"),
            "ranking",
            (F.col("discount") * 1000).cast("int").alias("percentile_ranking"),
        )
    )


def interest_map(spark: SparkSession, folder: str) -> DataFrame:
    """Known interests: solvent suppliers, and some ids without any figures."""
    suppliers = (
        load(spark, folder, "supplier")
        .filter(F.col("s_acctbal") >= 0)
        .select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("interest_name"),
            F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int")).alias("created_at"),
        )
    )
    unused = load(spark, folder, "nation").select(
        (-F.col("n_nationkey") - 1).cast("bigint").alias("id"),
        F.col("n_name").alias("interest_name"),
        F.lit("1996-01-01").cast("date").alias("created_at"),
    )
    return suppliers.unionByName(unused)
