"""Study 4: nodes, transactions and balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.functions import dates as d
from tallywork.functions.numbers import ratio
from tallywork.operators import aggregates as agg
from tallywork.operators import ledger as lg
from tallywork.operators import percentiles as pc
from tallywork.operators.recipes import joined_text
from tallywork.plans.registry import Registry, sql_ratio
from tallywork.sources import views as v
from tallywork.sources.tables import preview


def nodes_by_region(spark, folder):
    counts = agg.distinct_count(v.customer_nodes(spark, folder), ["region_id"], "node_id", "nodes_count")
    return counts.join(v.regions(spark, folder), "region_id").select("region_name", "nodes_count")


def rows_by_region(spark, folder):
    counts = v.customer_nodes(spark, folder).groupBy("region_id").agg(
        F.count("customer_id").alias("allocations"), F.countDistinct("customer_id").alias("customers")
    )
    return counts.join(v.regions(spark, folder), "region_id").select("region_name", "allocations", "customers")


def node_days(spark, folder, keys, inclusive=True):
    """Days per customer and node, open stays left out."""
    closed = v.customer_nodes(spark, folder).filter(F.col("end_date") != F.lit(v.OPEN_END).cast("date"))
    days = d.days_span(F.col("start_date"), F.col("end_date"), inclusive)
    return agg.total(closed, [*keys, "customer_id", "node_id"], days, "days")


def avg_days_on_node(spark, folder, inclusive=True):
    sums = node_days(spark, folder, [], inclusive).agg(F.sum("days").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.select(ratio(F.col("s"), F.col("n"), 0).alias("avg_relocation_days"))


def node_day_percentiles(spark, folder):
    hist = pc.histogram(node_days(spark, folder, ["region_id"]), ["region_id"], "days")
    return pc.band_means(pc.positions(hist, ["region_id"], "days"), ["region_id"], "days", [80, 95])


def txn_by_type(spark, folder):
    return v.transactions(spark, folder).groupBy("txn_type").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("txn_amount").alias("total_amount")
    )


def avg_deposits(spark, folder):
    per_customer = v.transactions(spark, folder).filter(F.col("txn_type") == "deposit").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("txn_amount").alias("s")
    )
    mean = F.round(F.col("s").cast("decimal(28,2)") / F.col("n").cast("decimal(10,0)"), 6).cast("decimal(28,6)")
    sums = per_customer.agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(mean).alias("m")
    )
    customers = F.col("c").cast("decimal(18,0)")
    return sums.select(
        ratio(F.col("n"), F.col("c"), 0).alias("avg_deposit_count"),
        ratio(F.col("s"), F.col("c"), 0).alias("avg_deposit_total"),
        F.round(F.col("m") / customers, 0).alias("avg_of_avg_amount"),
    )


def month_of(df):
    return df.withColumn("month", d.month_start(F.col("txn_date")))


def named_month(df):
    return df.withColumn("month_name", d.month_name(F.col("month")))


def active_by_month(spark, folder):
    """More than one deposit, and a purchase or a withdrawal: conditional counts."""
    kind = F.col("txn_type")
    monthly = month_of(v.transactions(spark, folder)).groupBy("month", "customer_id").agg(
        agg.count_when(kind == "deposit").alias("deposits"),
        agg.count_when(kind == "purchase").alias("purchases"),
        agg.count_when(kind == "withdrawal").alias("withdrawals"),
    )
    active = monthly.filter((F.col("deposits") > 1) & ((F.col("purchases") >= 1) | (F.col("withdrawals") >= 1)))
    return named_month(agg.count_rows(active, ["month"], "customer_count"))


def active_by_month_pivot(spark, folder):
    """The same through a pivot of counts."""
    kinds = ["deposit", "purchase", "withdrawal"]
    wide = month_of(v.transactions(spark, folder)).groupBy("month", "customer_id").pivot("txn_type", kinds).count()
    active = wide.filter((F.col("deposit") > 1) & (F.col("purchase").isNotNull() | F.col("withdrawal").isNotNull()))
    return named_month(agg.count_rows(active, ["month"], "customer_count"))


def active_by_month_text(spark, folder):
    """The same through the text of the kinds that occur."""
    counts = agg.count_rows(month_of(v.transactions(spark, folder)), ["month", "customer_id", "txn_type"])
    kept = counts.filter(((F.col("txn_type") == "deposit") & (F.col("n") > 1)) | (F.col("txn_type") != "deposit"))
    texts = kept.groupBy("month", "customer_id").agg(joined_text("txn_type", " ", "txn_type").alias("kinds"))
    kinds = F.col("kinds")
    active = texts.filter(kinds.like("%deposit%") & (kinds.like("%withdrawal%") | kinds.like("%purchase%")))
    return named_month(agg.count_rows(active, ["month"], "customer_count"))


def closing(spark, folder):
    return lg.closing_balance(v.transactions(spark, folder))


def closing_balance_months(spark, folder):
    """A spine of four stated months, as one would ask for the start of a year."""
    return lg.closing_balance(v.transactions(spark, folder), "2000-01-01", "2000-04-01")


def alloc_monthly(spark, folder):
    changed = closing(spark, folder).filter(F.col("total_month_change") != 0)
    return lg.sizes(changed, {"tot_size_bytes": "closing_balance"})


def alloc_stats(spark, folder):
    stats = lg.balance_stats(v.transactions(spark, folder)).withColumn(
        "avg_balance", F.col("avg_balance").cast(lg.BALANCE)
    )
    columns = {f"{k}_tot_bytes": f"{k}_balance" for k in ("min", "max", "avg")}
    return lg.sizes(stats, columns)


def alloc_realtime(spark, folder):
    daily = lg.daily_balance(v.transactions(spark, folder))
    return lg.sizes(daily, {"tot_size_bytes": "balance"}, F.col("rows"))


def column_bytes(spark, folder):
    txns = v.transactions(spark, folder)
    return lg.sizes(txns, {"customer_id_bytes": "customer_id", "txn_type_bytes": "txn_type"})


def sample_median(spark, folder):
    hist = pc.histogram(v.transactions(spark, folder), [], "txn_amount")
    return pc.median(pc.sliced_positions(hist, "txn_amount"), "txn_amount", "median_amount")


def on_txns(operator, *args):
    return lambda spark, folder: operator(v.transactions(spark, folder), *args)


def register(r: Registry) -> None:
    r.add("preview_nodes",
          lambda s, f: preview(v.customer_nodes(s, f), ["customer_id", "start_date", "end_date", "node_id"], 100),
          "v_nodes", "select * from v_nodes order by customer_id, start_date, end_date, node_id limit 100")
    r.add("unique_nodes", lambda s, f: agg.distinct_count(v.customer_nodes(s, f), [], "node_id", "nodes"), "v_nodes",
          "select count(distinct node_id) as nodes from v_nodes")
    named = "v_nodes join region on r_regionkey = region_id"
    r.add("nodes_by_region", nodes_by_region, "v_nodes",
          f"select r_name as region_name, count(distinct node_id) as nodes_count from {named} group by 1")
    r.add("rows_by_region", rows_by_region, "v_nodes", f"""
select r_name as region_name, count(customer_id) as allocations, count(distinct customer_id) as customers
from {named} group by 1""")
    stay = "select {0} customer_id, node_id, cast(sum(end_date - start_date + {1}) as bigint) as days from v_nodes " \
           "where end_date <> date '9999-12-31' group by all"
    for key, plus in (("avg_days_on_node", 1), ("avg_days_on_node_exclusive", 0)):
        r.add(key, lambda s, f, plus=plus: avg_days_on_node(s, f, plus == 1), "v_nodes", f"""
select {sql_ratio('sum(days)', 'count(*)', 0)} as avg_relocation_days from ({stay.format('', plus)}) t""")
    r.add("node_day_percentiles", node_day_percentiles, "v_nodes", f"""
with ranked as (select region_id, days, row_number() over (partition by region_id order by days) as rn,
                       count(*) over (partition by region_id) as n from ({stay.format('region_id,', 1)}) t),
tagged as (select region_id, days, 50 as percentile from ranked where rn in ((n + 1) // 2, (n + 2) // 2)
           union all select region_id, days, cast((200 * rn + n) // (2 * n) as int) from ranked
                     where (200 * rn + n) // (2 * n) in (80, 95))
select region_id, percentile, {sql_ratio('sum(days)', 'count(*)', 2)} as avg_days from tagged group by 1, 2""")
    r.add("txn_by_type", txn_by_type, "v_txns", """
select txn_type, count(*) as transaction_count, cast(sum(txn_amount) as double) as total_amount from v_txns group by 1""")
    mean = sql_ratio("s", "n", 6)
    r.add("avg_deposits", avg_deposits, "v_txns", f"""
select {sql_ratio('sum(n)', 'count(*)', 0)} as avg_deposit_count, {sql_ratio('sum(s)', 'count(*)', 0)} as avg_deposit_total,
       round(avg({mean})) as avg_of_avg_amount
from (select customer_id, count(*) as n, sum(txn_amount) as s from v_txns where txn_type = 'deposit' group by 1) t""")
    active = """
select cast(month as date) as month, monthname(month) as month_name, count(*) as customer_count
from (select date_trunc('month', txn_date) as month, customer_id, count(*) filter (txn_type = 'deposit') as deposits,
             count(*) filter (txn_type = 'purchase') as purchases, count(*) filter (txn_type = 'withdrawal') as withdrawals
      from v_txns group by 1, 2) t
where deposits > 1 and (purchases >= 1 or withdrawals >= 1) group by 1, 2"""
    r.add("active_customers_by_month", active_by_month, "v_txns", active)
    r.add("active_customers_by_month_pivot", active_by_month_pivot, "v_txns", active)
    r.add("active_customers_by_month_text", active_by_month_text, "v_txns", active)
    sign = "case txn_type when 'deposit' then txn_amount when 'purchase' then -txn_amount when 'withdrawal' then -txn_amount end"
    spine = f"""
spine as (select customer_id, last_day(cast(m as date)) as month_end
          from (select distinct customer_id from v_txns) c,
               (select unnest(generate_series({{0}}, {{1}}, interval 1 month)) as m) s),
moved as (select customer_id, last_day(txn_date) as month_end, sum({sign}) as amount from v_txns group by 1, 2),
closing as (select customer_id, month_end, coalesce(amount, 0) as total_month_change,
                   sum(coalesce(amount, 0)) over (partition by customer_id order by month_end) as closing_balance
            from spine left join moved using (customer_id, month_end)),
changes as (select *, lag(closing_balance) over (partition by customer_id order by month_end) as before from closing)"""
    whole = spine.format(
        "(select date_trunc('month', min(txn_date)) from v_txns)", "(select date_trunc('month', max(txn_date)) from v_txns)"
    )
    year = spine.format("date '2000-01-01'", "date '2000-04-01'")
    balances = """
select customer_id, month_end, cast(total_month_change as double) as total_month_change,
       cast(closing_balance as double) as closing_balance"""
    r.add("closing_balance", closing, "v_txns", f"with {whole} {balances} from closing")
    r.add("closing_balance_months", closing_balance_months, "v_txns", f"with {year} {balances} from closing")
    pct = sql_ratio("total_month_change", "before", 0, 100)
    r.add("balance_change_pct", lambda s, f: lg.balance_change(closing(s, f)), "v_txns",
          f"with {whole} {balances}, {pct} as percent_change from changes")
    r.add("pct_customers_growing", lambda s, f: lg.growing_customers(closing(s, f), 5), "v_txns", f"""
with {whole} select {sql_ratio(f'(select count(distinct customer_id) from changes where {pct} >= 5)',
                               '(select count(distinct customer_id) from v_txns)', 4)}
         as percent_customers_with_balance_growth""")
    running = f"""select *, sum({sign}) over (partition by customer_id order by txn_date) as running from v_txns"""
    r.add("running_balance", on_txns(lg.running_balance), "v_txns", f"""
select customer_id, txn_id, txn_date, txn_type, cast(txn_amount as double) as txn_amount,
       cast(running as double) as running_total_balance from ({running}) t""")
    r.add("running_balance_stats", on_txns(lg.balance_stats), "v_txns", f"""
select customer_id, cast(min(running) as double) as min_balance, cast(max(running) as double) as max_balance,
       {sql_ratio('sum(running)', 'count(*)', 0)} as avg_balance from ({running}) t group by 1""")
    r.add("alloc_monthly", alloc_monthly, "v_txns", f"""
with {whole} select count(*) as number_of_rows, count(*) * 8 as tot_size_bytes from closing where total_month_change <> 0""")
    r.add("alloc_stats", alloc_stats, "v_txns", """
select n as number_of_rows, n * 8 as min_tot_bytes, n * 8 as max_tot_bytes, n * 8 as avg_tot_bytes
from (select count(distinct customer_id) as n from v_txns) t""")
    r.add("alloc_realtime", alloc_realtime, "v_txns",
          "select count(*) as number_of_rows, count(*) * 8 as tot_size_bytes from v_txns")
    r.add("column_bytes", column_bytes, "v_txns", """
select count(*) as number_of_rows, count(customer_id) * 8 as customer_id_bytes,
       cast(sum(strlen(txn_type)) as bigint) as txn_type_bytes from v_txns""")
    r.add("sample_median", sample_median, "v_txns",
          "select round(median(cast(txn_amount as double)), 3) as median_amount from v_txns")
    spans = f"""
daily as (select distinct customer_id, txn_date, sum({sign}) over (partition by customer_id order by txn_date) as balance
          from v_txns),
spans as (select customer_id, balance, txn_date as d0, coalesce(lead(txn_date) over (partition by customer_id order by txn_date),
            (select last_day(max(txn_date)) + 1 from v_txns)) as d1 from daily)"""
    r.add("simple_interest", on_txns(lg.simple_interest, "0.06"), "v_txns", f"""
with {spans}
select cast(date_trunc('month', day) as date) as month, {sql_ratio('sum(balance) * 6', '36500', 2)} as interest
from (select balance, unnest(range(d0, d1, interval 1 day)) as day from spans) t group by 1""")
    r.add("compound_interest", on_txns(lg.compound_interest, 0.06, "1995-01-01"), "v_txns", f"""
with known as (select customer_id, min(txn_date) as since, (select max(last_day(txn_date)) from v_txns) as until from v_txns group by 1),
ends as (select customer_id, last_day(unnest(range(date_trunc('month', since), until + 1, interval 1 month))::date) as month_end from known)
select e.customer_id, e.month_end,
       round(sum(cast({sign} as double) * pow(1 + 0.06::double / 365, e.month_end - t.txn_date)), 2) as balance_with_interest
from ends e join v_txns t on t.customer_id = e.customer_id and t.txn_date <= e.month_end group by 1, 2""")
