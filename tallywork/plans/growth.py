"""Figures that have to hold for keys and tables of any size: mergeable counts, percentiles per key,
frames on raw rows, joins by range and by time, tables rewritten in part."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.functions.numbers import percent
from tallywork.operators import percentiles as pc
from tallywork.operators import sketches as sk
from tallywork.operators.histories import as_of
from tallywork.operators.ranges import in_intervals
from tallywork.operators.series import numbers
from tallywork.operators.skew import full_join, number_rows
from tallywork.operators.slices import rows_frame, running_frame
from tallywork.plans.interests import metrics
from tallywork.plans.registry import Registry, sql_ratio
from tallywork.sources import tables as tb
from tallywork.sources import views as v

SHARES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
CAMPAIGN_STEP, CAMPAIGN_DAYS = 80, 30


def in_all_months_bitmap(spark, folder):
    month = (F.year("month_start") * 12 + F.month("month_start")).cast("bigint").alias("month")
    months = metrics(spark, folder).filter("month_start is not null").select("interest_id", month)
    return sk.divided(months, "interest_id", "month", months.select("month"), "total_months")


def heads(spark, folder):
    """Orders with the year, state and size of each."""
    orders = v.load(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("txn_date"),
        F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        v.money(F.col("o_totalprice")).alias("amount"),
    )


def customers_cube(spark, folder):
    return sk.cube_distinct(heads(spark, folder), ["year", "status", "priority"], "customer_id", "customers")


def approx_customers(spark, folder):
    """Customers per year and state from sketches of single days, held against the exact number."""
    orders = heads(spark, folder)
    daily = sk.distinct_sketches(orders, ["txn_date", "status"], "customer_id")
    merged = sk.merged_distinct(daily.withColumn("year", F.year("txn_date")), ["year", "status"], "estimate")
    bits = sk.distinct_bitmaps(orders, ["year", "status"], "customer_id")
    both = merged.join(sk.merged_bits(bits, ["year", "status"], "customers"), ["year", "status"])
    near = F.abs(F.col("estimate") - F.col("customers")) <= F.col("customers") * sk.distinct_error() + 1
    return both.select("year", "status", "customers", near.alias("within_error"))


def priced(spark, folder):
    return v.basket_lines(spark, folder).select("flag", F.date_trunc("month", "ship_date").alias("month"), "price")


def price_percentiles(spark, folder):
    found = pc.percentiles(priced(spark, folder), ["flag"], "price", SHARES)
    return found.select("flag", "rows", *[F.round(f"{n}_cont", 4).alias(f"{n}_cont") for n in SHARES], *[f"{n}_disc" for n in SHARES])


def approx_price_percentiles(spark, folder):
    """Percentiles per flag from sketches of single months, held against the exact ranks."""
    lines = priced(spark, folder)
    monthly = pc.quantile_sketches(lines, ["flag", "month"], "price")
    merged = pc.merged_quantiles(monthly, ["flag"], SHARES)
    counts = lines.withColumn("price", F.col("price").cast("double")).join(merged.drop("rows"), "flag").groupBy("flag").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col("price") < F.col(f"{n}_approx")).alias(f"{n}_less") for n in SHARES],
        *[F.count_if(F.col("price") <= F.col(f"{n}_approx")).alias(f"{n}_most") for n in SHARES],
    )
    slack = F.col("rows") * pc.kll_error() + 1
    near = [((F.col(f"{n}_less") - slack <= F.col("rows") * p) & (F.col("rows") * p <= F.col(f"{n}_most") + slack)).alias(f"{n}_within") for n, p in SHARES.items()]
    return counts.select("flag", "rows", *near)


def frame_rows_by_type(spark, folder):
    """Frames over single transactions; a type has a third of all rows."""
    txns = v.transactions(spark, folder).select("txn_type", "txn_date", "txn_id", "txn_amount")
    sums = {"around": F.sum("txn_amount"), "highest": F.max("txn_amount"), "rows": F.count(F.lit(1))}
    return rows_frame(txns, ["txn_type"], ["txn_date", "txn_id"], sums, 2, 1).drop("txn_date")


def running_by_type(spark, folder):
    txns = v.transactions(spark, folder).select("txn_type", "txn_date", "txn_id", "txn_amount")
    return running_frame(txns, ["txn_type"], ["txn_date", "txn_id"], F.col("txn_amount"), "running").select("txn_type", "txn_id", "running")


def numbered_by_type(spark, folder):
    txns = v.transactions(spark, folder).select("txn_type", "txn_date", "txn_id")
    return number_rows(txns, ["txn_type"], ["txn_date", "txn_id"], "number", [F.col("txn_date")]).select("txn_type", "txn_id", "number")


def price_before(spark, folder):
    """What a product cost when it was last shipped before the day of each line."""
    line = v.load(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key"), F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("ship_date"), v.money(F.col("l_extendedprice")).alias("price"),
    )
    history = line.select("product_id", F.col("ship_date").alias("since"), F.col("line_key").alias("earlier_line"), F.col("price").alias("earlier_price"))
    found = as_of(line, history, ["product_id"], "ship_date", "since", ["earlier_line", "earlier_price"], "earlier_line", "line_key", inclusive=False)
    return found.select("line_key", "product_id", "price", "earlier_line", "earlier_price")


def campaigns(spark, folder):
    """A campaign per nation: intervals that overlap, the last one open."""
    key = F.col("n_nationkey")
    start = F.date_add(F.lit("1995-01-15").cast("date"), key * CAMPAIGN_STEP)
    return v.load(spark, folder, "nation").select(
        key.alias("campaign_id"), F.col("n_name").alias("campaign"), start.alias("starts"), F.when(key != 24, F.date_add(start, key * 5 + CAMPAIGN_DAYS)).alias("ends")
    )


def sales_in_campaigns(spark, folder):
    """Orders of each campaign's days: a join by range alone, there is no equal key."""
    inside = in_intervals(heads(spark, folder), campaigns(spark, folder), "txn_date", "starts", "ends", closed=False)
    return inside.groupBy("campaign_id", "campaign").agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"))


def orders_rollup(spark, folder):
    """Totals per year and state, per year, and over all; counts under conditions."""
    few, many = F.count_if(F.col("amount") < 1000).alias("small"), F.count_if(F.col("priority").startswith("1")).alias("urgent")
    return heads(spark, folder).rollup("year", "status").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"), few, many)


def orders_cube(spark, folder):
    return heads(spark, folder).cube("status", "priority").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("orders"), F.max("amount").alias("highest"))


def restated_prices(spark, folder):
    """The catalogue as a stored table: a new product is appended and one category repriced in place."""
    path, parts = tb.new_path(spark, "catalogue"), ["category_name"]
    catalogue = v.products(spark, folder)
    tb.append_rows(catalogue, path, parts)
    first = catalogue.agg(F.min("category_name").alias("category_name"), F.max("product_id").alias("top"))
    new = first.select((F.col("top") + 1).alias("product_id"), F.lit("new product").alias("product_name"), F.lit("Brand#0").alias("segment_name"), F.lit(5).cast("decimal(18,2)").alias("price"), "category_name")
    tb.append_rows(new, path, parts)
    least = first.select("category_name").first()["category_name"]
    changed = tb.rewrite_where(spark, path, parts, (F.col("category_name") == least) & (F.col("price") > 10), {"price": F.col("price") + 1})
    return changed.select("product_id", "product_name", "segment_name", "category_name", "price")


def order_margin_bucketed(spark, folder):
    """Orders whose lines don't add up to their total, by state: both tables are stored by the order's
    key, so neither the grouping of lines nor the join moves a row."""
    lines = v.load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("txn_id"), v.money(F.col("l_extendedprice")).alias("price"))
    left, right = stored_by_order(spark, lines, "lines"), stored_by_order(spark, heads(spark, folder).select("txn_id", "status", "amount"), "heads")
    return margins(left, right)


def stored_by_order(spark, df, name):
    path = tb.new_path(spark, name)
    return tb.store_bucketed(df, path.rsplit("/", 1)[-1].replace("-", "_"), path, ["txn_id"], int(spark.conf.get("spark.sql.shuffle.partitions")))


def margins(lines, orders):
    sums = lines.groupBy("txn_id").agg(F.sum("price").alias("lines"))
    both = orders.join(sums, "txn_id").groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("lines") > F.col("amount")).alias("above"), F.sum(F.col("lines") - F.col("amount")).alias("difference")
    )
    return both


def members_and_events(spark, folder):
    """Members and users of the event table side by side, whichever of them there is."""
    users = v.subscriptions(spark, folder).groupBy("customer_id").agg(F.count(F.lit(1)).alias("events"))
    return full_join(v.members(spark, folder), users, ["customer_id"])


def orders_by_lines(spark, folder):
    """Orders by their number of lines, the numbers without orders too."""
    sizes = v.basket_lines(spark, folder).groupBy("txn_id").agg(F.count(F.lit(1)).alias("lines"))
    counts = sizes.groupBy("lines").agg(F.count(F.lit(1)).alias("orders"))
    return numbers(spark, 1, 10, "lines").join(counts, "lines", "left").select("lines", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"))


def shares_from_view(spark, folder):
    """A stored view, asked in SQL."""
    tb.as_view(v.transactions(spark, folder).groupBy("txn_type").agg(F.count(F.lit(1)).alias("n")), "tallywork_types")
    whole = "(select sum(n) from tallywork_types)"
    return spark.sql(f"select txn_type, n, {whole} as whole from tallywork_types").select("txn_type", "n", percent(F.col("n"), F.col("whole"), 2).alias("share"))


def register(r: Registry) -> None:
    r.add("in_all_months_bitmap", in_all_months_bitmap, "v_monthly", """
select interest_id, count(distinct month_start) as total_months from v_monthly group by 1
having count(distinct month_start) = (select count(distinct month_start) from v_monthly)""")
    r.add("customers_cube", customers_cube, "v_heads", """
select year, status, priority, grouping_id(year, status, priority)::int as grouping_id, count(distinct customer_id) as customers
from v_heads group by cube (year, status, priority)""")
    r.add("approx_customers", approx_customers, "v_heads", """
select year, status, count(distinct customer_id) as customers, true as within_error from v_heads group by 1, 2""")
    cont = ", ".join(f"round(quantile_cont(price::double, {p}), 4) as {n}_cont" for n, p in SHARES.items())
    disc = ", ".join(f"quantile_disc(price, {p})::double as {n}_disc" for n, p in SHARES.items())
    r.add("price_percentiles", price_percentiles, "v_lines", f"select flag, count(price) as rows, {cont}, {disc} from v_lines group by 1")
    r.add("approx_price_percentiles", approx_price_percentiles, "v_lines",
          "select flag, count(*) as rows, " + ", ".join(f"true as {n}_within" for n in SHARES) + " from v_lines group by 1")
    r.add("frame_rows_by_type", frame_rows_by_type, "v_txns", """
select txn_type, txn_id, txn_amount::double as txn_amount, (sum(txn_amount) over w)::double as around,
       (max(txn_amount) over w)::double as highest, count(*) over w as rows
from v_txns window w as (partition by txn_type order by txn_date, txn_id rows between 2 preceding and 1 following)""")
    r.add("running_by_type", running_by_type, "v_txns", """
select txn_type, txn_id, (sum(txn_amount) over (partition by txn_type order by txn_date, txn_id rows unbounded preceding))::double as running
from v_txns""")
    r.add("numbered_by_type", numbered_by_type, "v_txns", """
select txn_type, txn_id, row_number() over (partition by txn_type order by txn_date, txn_id) as number from v_txns""")
    r.add("price_before", price_before, "", """
with line as (select l_orderkey * 8 + l_linenumber as line_key, l_partkey as product_id, cast(l_shipdate as date) as ship_date,
              cast(l_extendedprice as decimal(18,2)) as price from lineitem),
latest as (select product_id, ship_date, max(line_key) as earlier_line from line group by 1, 2),
known as (select product_id, line.ship_date, earlier_line, price as earlier_price from latest join line using (product_id) where line_key = earlier_line)
select l.line_key, l.product_id, l.price::double as price, k.earlier_line, k.earlier_price::double as earlier_price
from line l asof left join known k on k.product_id = l.product_id and k.ship_date < l.ship_date""")
    r.add("sales_in_campaigns", sales_in_campaigns, "v_heads", f"""
with campaigns as (select n_nationkey as campaign_id, n_name as campaign, date '1995-01-15' + cast(n_nationkey * {CAMPAIGN_STEP} as int) as starts,
  case when n_nationkey <> 24 then date '1995-01-15' + cast(n_nationkey * {CAMPAIGN_STEP + 5} + {CAMPAIGN_DAYS} as int) end as ends from nation)
select campaign_id, campaign, count(*) as orders, sum(amount)::double as amount
from campaigns join v_heads on txn_date >= starts and (ends is null or txn_date < ends) group by 1, 2""")
    r.add("orders_rollup", orders_rollup, "v_heads", """
select year, status, grouping_id(year, status) as level, count(*) as orders, sum(amount)::double as amount,
       count(*) filter (amount < 1000) as small, count(*) filter (priority like '1%') as urgent
from v_heads group by rollup (year, status)""")
    r.add("orders_cube", orders_cube, "v_heads", """
select status, priority, grouping_id(status, priority) as level, count(*) as orders, max(amount)::double as highest
from v_heads group by cube (status, priority)""")
    r.add("restated_prices", restated_prices, "v_products", """
with least as (select min(category_name) as c, max(product_id) as top from v_products)
select product_id, product_name, segment_name, category_name,
       (case when category_name = c and price > 10 then price + 1 else price end)::double as price from v_products, least
union all select top + 1, 'new product', 'Brand#0', c, 5.0::double from least""")
    r.add("order_margin_bucketed", order_margin_bucketed, "v_heads", """
with sums as (select l_orderkey as txn_id, sum(cast(l_extendedprice as decimal(18,2))) as lines from lineitem group by 1)
select status, count(*) as orders, count(*) filter (lines > amount) as above, sum(lines - amount)::double as difference
from v_heads join sums using (txn_id) group by 1""")
    r.add("members_and_events", members_and_events, "v_members v_subs", """
select customer_id, join_date, events
from v_members full join (select customer_id, count(*) as events from v_subs group by 1) u using (customer_id)""")
    r.add("orders_by_lines", orders_by_lines, "v_lines", """
select lines, coalesce(orders, 0) as orders from (select unnest(range(1, 11)) as lines) n
left join (select c as lines, count(*) as orders from (select count(*) as c from v_lines group by txn_id) t group by 1) using (lines)""")
    r.add("shares_from_view", shares_from_view, "v_txns", f"""
select txn_type, n, {sql_ratio('n', 'sum(n) over ()', 2, 100)} as share from (select txn_type, count(*) as n from v_txns group by 1) t""")
