"""The business views again, in the SQL of the checking engine."""

from __future__ import annotations

# name -> (views it needs, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_sales": ((), """
select o.o_custkey as customer_id, cast(o.o_orderdate as date) as order_date, l.l_orderkey as txn_id,
       l.l_linenumber as line_no, l.l_partkey as product_id, cast(l.l_quantity as int) as qty,
       cast(l.l_extendedprice as decimal(18,2)) as price, cast(l.l_discount as decimal(18,2)) as discount,
       l.l_returnflag as flag, cast(l.l_shipdate as date) as ship_date
from lineitem l join orders o on o.o_orderkey = l.l_orderkey"""),
    "v_lines": ((), """
select l_orderkey as txn_id, l_partkey as product_id, cast(l_quantity as int) as qty,
       cast(l_extendedprice as decimal(18,2)) as price, cast(l_discount as decimal(18,2)) as discount,
       l_returnflag as flag, cast(l_shipdate as date) as ship_date
from lineitem"""),
    "v_products": ((), """
select p_partkey as product_id, p_name as product_name, p_brand as segment_name, p_type as category_name,
       cast(p_retailprice as decimal(18,2)) as price
from part"""),
    "v_members": ((), """
select o_custkey as customer_id, cast(min(o_orderdate) as date) + 365 as join_date
from orders group by o_custkey having count(*) >= 12"""),
    "v_plans": ((), """
select plan_id, plan_name, cast(price as decimal(5,2)) as price
from (values (0,'signup',0.0),(1,'view',9.90),(2,'click',19.90),(3,'purchase',199.0),(4,'error',null))
     t(plan_id, plan_name, price)"""),
    "v_subs": ((), """
select user_id as customer_id, event_id, cast(ts as date) as start_date,
       case event_type when 'signup' then 0 when 'view' then 1 when 'click' then 2 when 'purchase' then 3 else 4 end
         as plan_id
from events"""),
    "v_txns": ((), """
select o_orderkey as txn_id, o_custkey as customer_id, cast(o_orderdate as date) as txn_date,
       case o_orderstatus when 'F' then 'deposit' when 'O' then 'purchase' else 'withdrawal' end as txn_type,
       cast(o_totalprice as decimal(18,2)) as txn_amount
from orders"""),
    "v_heads": ((), """
select o_orderkey as txn_id, o_custkey as customer_id, cast(o_orderdate as date) as txn_date, cast(year(o_orderdate) as int) as year,
       o_orderstatus as status, o_orderpriority as priority, cast(o_totalprice as decimal(18,2)) as amount
from orders"""),
    "v_nodes": ((), """
select o.o_custkey as customer_id, n.n_regionkey as region_id, cast(o.o_orderkey % 5 + 1 as int) as node_id,
       cast(o.o_orderdate as date) as start_date,
       coalesce(cast(lead(o.o_orderdate) over (partition by o.o_custkey order by o.o_orderdate, o.o_orderkey) as date),
                date '9999-12-31') as end_date
from orders o join customer c on c.c_custkey = o.o_custkey join nation n on n.n_nationkey = c.c_nationkey"""),
    "v_weekly": ((), """
select strftime(o.o_orderdate, '%-d/%-m/%y') as week_date, r.r_name as region,
       case l.l_linestatus when 'F' then 'Retail' else 'Shopify' end as platform,
       case l.l_linenumber % 5 when 0 then 'null'
            else (case l.l_returnflag when 'A' then 'C' else 'F' end) || cast(l.l_linenumber % 5 as varchar) end
         as segment,
       c.c_mktsegment as customer_type, cast(l.l_quantity as int) as transactions,
       cast(l.l_extendedprice as decimal(18,2)) as sales
from lineitem l join orders o on o.o_orderkey = l.l_orderkey join customer c on c.c_custkey = o.o_custkey
     join nation n on n.n_nationkey = c.c_nationkey join region r on r.r_regionkey = n.n_regionkey"""),
    "v_clean_weekly": (("v_weekly",), """
select cast(strptime(week_date, '%d/%m/%y') as date) as week_date_,
       cast((day(strptime(week_date, '%d/%m/%y')) - 1) // 7 + 1 as int) as week_number,
       cast((dayofyear(strptime(week_date, '%d/%m/%y')) - 1) // 7 + 1 as int) as week_of_year,
       cast(month(strptime(week_date, '%d/%m/%y')) as int) as month_number,
       cast(year(strptime(week_date, '%d/%m/%y')) as int) as calendar_year,
       case when segment = 'null' then 'unknown' else segment end as segment,
       case when segment = 'null' then 'unknown' when right(segment, 1) = '1' then 'Young Adults'
            when right(segment, 1) = '2' then 'Middle Aged' when right(segment, 1) in ('3','4') then 'Retirees' end
         as age_band,
       case when segment = 'null' then 'unknown' when left(segment, 1) = 'C' then 'Couples'
            when left(segment, 1) = 'F' then 'Families' end as demographic,
       case when transactions = 0 then null
            else (2 * cast(sales * 100 as hugeint) + transactions) // (2 * transactions) / 100.0::double end
         as avg_transaction,
       region, platform, customer_type, transactions, sales
from v_weekly"""),
    "v_tree": ((), """
select cast(1000 + r_regionkey as bigint) as id, cast(null as bigint) as parent_id, r_name as level_text from region
union all select cast(2000 + n_nationkey as bigint), cast(1000 + n_regionkey as bigint), n_name from nation
union all select 10000 + s_suppkey, cast(2000 + s_nationkey as bigint), s_name from supplier"""),
    "v_prices": ((), """
select 10000 + s_suppkey as id, 'P' || cast(s_suppkey as varchar) as product_id,
       cast(s_acctbal as decimal(18,2)) as price
from supplier where s_acctbal >= 0"""),
    "v_deliveries": ((), """
select o_orderkey as order_id, o_custkey % 10 as runner_id,
       case when o_orderkey % 4 <> 0 then o_orderdate + to_minutes(o_orderkey % 50 + 10)
            + to_seconds(o_orderkey % 60) end as pickup_time,
       case when o_orderkey % 4 <> 0 then cast(o_orderkey % 40 + 5 as double) end as distance,
       case when o_orderkey % 5 <> 0 then cast(o_orderkey % 50 + 10 as double) end as duration,
       case when o_orderkey % 4 = 0 then 'Customer Cancellation' end as cancellation
from orders"""),
    "v_items": ((), """
select order_id, row_number() over (partition by order_id
         order by pizza_id, coalesce(exclusions, ''), coalesce(extras, '')) as order_item_id,
       customer_id, pizza_id, exclusions, extras, order_time
from (select l.l_orderkey as order_id, o.o_custkey as customer_id, l.l_partkey as pizza_id, o.o_orderdate as order_time,
        case (l_partkey + l_linenumber) % 5
          when 2 then cast(l_partkey % 25 + 1 as varchar)
          when 3 then cast(l_partkey % 25 + 1 as varchar) || ',' || cast((l_partkey + 7) % 25 + 1 as varchar) end
          as exclusions,
        case l_suppkey % 4
          when 2 then cast(l_suppkey % 25 + 1 as varchar)
          when 3 then cast(l_suppkey % 25 + 1 as varchar) || ',' || cast((l_suppkey + 3) % 25 + 1 as varchar)
                      || ',' || cast((l_suppkey + 11) % 25 + 1 as varchar) end as extras
      from lineitem l join orders o on o.o_orderkey = l.l_orderkey) t"""),
    "v_changes": (("v_items",), """
select order_id, order_item_id, 'Exclude' as change_type, cast(unnest(string_split(exclusions, ',')) as int) as topping_id
from v_items where exclusions is not null
union all
select order_id, order_item_id, 'Extra', cast(unnest(string_split(extras, ',')) as int)
from v_items where extras is not null"""),
    "v_pizzas": ((), """
select p_partkey as pizza_id, p_name as pizza_name, p_brand as family,
       cast(p_retailprice as decimal(18,2)) as price
from part"""),
    "v_recipes": ((), """
select p_partkey as pizza_id, p_brand as family,
       cast(unnest([p_partkey % 25 + 1, (p_partkey + 1 + p_size % 5) % 25 + 1, (p_partkey + 7) % 25 + 1,
              (p_partkey + 12 + p_size % 3) % 25 + 1]) as int) as topping_id
from part"""),
    "v_toppings": ((), "select n_nationkey + 1 as topping_id, n_name as topping_name from nation"),
    "v_metrics": ((), """
select interest_id, month_year, composition, tax + 1 as index_value, ranking,
       cast(discount * 1000 as int) as percentile_ranking
from (select l_suppkey as interest_id, case when l_linenumber <> 7 then strftime(l_shipdate, '%m-%Y') end as month_year,
        cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) as composition,
        cast(sum(cast(l_tax as decimal(18,2))) as decimal(18,2)) as tax,
        cast(count(*) as int) as ranking, max(cast(l_discount as decimal(18,2))) as discount
      from lineitem group by 1, 2) t"""),
    "v_monthly": (("v_metrics",), """
select interest_id, cast(strptime(month_year, '%m-%Y') as date) as month_start, composition, index_value, ranking,
       percentile_ranking
from v_metrics"""),
    "v_known": ((), """
select s_suppkey as id, s_name as interest_name, date '1996-01-01' + cast(s_suppkey % 1000 as int) as created_at
from supplier where s_acctbal >= 0
union all select cast(-n_nationkey - 1 as bigint), n_name, date '1996-01-01' from nation"""),
}
