"""Study 5: weekly sales before and after a change."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.functions import dates as d
from tallywork.operators import aggregates as agg
from tallywork.operators import periods as pr
from tallywork.plans.registry import Registry, sql_ratio
from tallywork.sources import views as v

DAY = "2000-06-15"
DIMENSIONS = ["region", "platform", "age_band", "demographic", "customer_type"]


def clean(spark, folder):
    return pr.clean_weekly_sales(v.weekly_sales(spark, folder))


def on_clean(operator, *args):
    return lambda spark, folder: operator(clean(spark, folder), *args)


def summed(keys, measure, name):
    return lambda spark, folder: agg.total(clean(spark, folder), keys, F.col(measure), name)


def weekday_used(spark, folder):
    return clean(spark, folder).select(d.weekday_number(F.col("week_date_")).alias("day_of_week")).distinct()


def weeks_present(spark, folder):
    return clean(spark, folder).select("calendar_year", "month_number", "week_number").distinct()


def register(r: Registry) -> None:
    view = "v_clean_weekly"
    r.add("clean_weekly_sales", clean, view,
          "select * replace (cast(sales as double) as sales) from v_clean_weekly")
    r.add("weekday_used", weekday_used, view, "select distinct cast(dayofweek(week_date_) as int) as day_of_week from v_clean_weekly")
    r.add("weeks_present", weeks_present, view,
          "select calendar_year, month_number, week_number from v_clean_weekly group by 1, 2, 3")
    for key, keys, measure, name in (
        ("txns_by_year", ["calendar_year"], "transactions", "total_number_of_transactions"),
        ("sales_region_month", ["region", "month_number"], "sales", "total_sales"),
        ("txns_by_platform", ["platform"], "transactions", "total_number_of_transactions"),
        ("sales_by_age", ["age_band"], "sales", "group_sales"),
        ("sales_by_demographic", ["demographic"], "sales", "group_sales"),
        ("sales_by_both", ["age_band", "demographic"], "sales", "group_sales"),
    ):
        kind = "bigint" if measure == "transactions" else "double"
        columns = ", ".join(keys)
        r.add(key, summed(keys, measure, name), view,
              f"select {columns}, cast(sum({measure}) as {kind}) as {name} from v_clean_weekly group by {columns}")
    parts = {p: f"sum(case when platform = '{p.capitalize()}' then transactions end)" for p in ("retail", "shopify")}
    shares = ", ".join(
        f"cast({s} as bigint) as {p}_transactions, {sql_ratio(s, 'sum(transactions)', 2, 100)} as percent_{p}_transactions"
        for p, s in parts.items()
    )
    r.add("platform_share", on_clean(pr.platform_shares), view,
          f"select {shares}, cast(sum(transactions) as bigint) as total_transactions from v_clean_weekly")
    r.add("platform_share_by_month", on_clean(pr.platform_shares, ["calendar_year", "month_number"]), view, f"""
select calendar_year, month_number, {shares}, cast(sum(transactions) as bigint) as total_transactions
from v_clean_weekly group by 1, 2""")
    r.add("avg_txn_two_ways", on_clean(pr.average_two_ways, ["calendar_year", "platform"]), view, f"""
select calendar_year, platform, {sql_ratio('sum(sales)', 'sum(transactions)', 2)} as avg_transaction,
       {sql_ratio('sum(cast(avg_transaction as decimal(18,2)))', 'count(avg_transaction)', 2)} as avg_of_avg_transaction
from v_clean_weekly group by 1, 2""")

    def side(name, day, weeks):
        where = (f"week_date_ >= date '{day}' - {7 * weeks} and week_date_ < date '{day}'" if name == "before"
                 else f"week_date_ >= date '{day}' and week_date_ <= date '{day}' + {7 * weeks}")
        return f"sum(case when {where} then sales end)"

    days = f"date_diff('day', date '{DAY}', week_date_)"
    r.add("before_after", on_clean(pr.before_after, DAY, 4), view, f"""
with named(later, changes) as (values (false, '{pr.BEFORE}'), (true, '{pr.AFTER}'))
select changes, cast(sum(sales) as double) as total_sales
from v_clean_weekly join named on later = ({days} >= 0) where abs({days}) <= 28 group by changes""")
    for key, weeks, scale in (("before_after_pct", 4, 2), ("before_after_pct_12", 12, 3)):
        b, a = side("before", DAY, weeks), side("after", DAY, weeks)
        r.add(key, on_clean(pr.before_after_percent, DAY, weeks, scale), view, f"""
select cast(b as double) as before_sales, cast(a as double) as after_sales, cast(a - b as double) as change,
       {sql_ratio('a - b', 'b', scale, 100)} as percent_change
from (select {b} as b, {a} as a from v_clean_weekly) t""")
    years = [2000, 1999, 1998]
    for key, weeks in (("before_after_years", 4), ("before_after_years_12", 12)):
        sums = ", ".join(
            f"{side('before', f'{y}-06-15', weeks)} as b{y}, {side('after', f'{y}-06-15', weeks)} as a{y}" for y in years
        )
        rows = []
        for letter, name in (("b", pr.BEFORE), ("a", pr.AFTER)):
            columns = ", ".join(
                f"cast({letter}{y} as double) as sales_{y}, "
                + (sql_ratio(f"a{y} - b{y}", f"b{y}", 3, 100) if letter == "a" else "cast(null as double)")
                + f" as percent_change_{y}"
                for y in years
            )
            rows.append(f"select '{name}' as changes, {columns} from totals")
        r.add(key, on_clean(pr.before_after_years, "06-15", years, weeks), view,
              f"with totals as (select {sums} from v_clean_weekly) {' union all '.join(rows)}")
    b, a = (f"coalesce(sum(sales) filter (days {sign} 0), 0)" for sign in ("<", ">="))
    r.add("impact_by_dimension", on_clean(pr.impact_by_dimension, DIMENSIONS, DAY, 12), view, f"""
with swing as (select {", ".join(DIMENSIONS)}, sales, {days} as days from v_clean_weekly where abs({days}) <= 84),
tall as (select * from swing unpivot include nulls (value for dimension in ({", ".join(DIMENSIONS)})))
select dimension, value, cast({b} as double) as before_changes, cast({a} as double) as after_changes, {sql_ratio(f'{a} - {b}', b, 2, 100)} as percent_change
from tall group by dimension, value""")
