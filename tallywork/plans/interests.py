"""Study 8: monthly figures per interest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywork.operators import aggregates as agg
from tallywork.operators import interests as it
from tallywork.plans.registry import Registry, sql_ratio
from tallywork.sources import views as v

MIN_MONTHS = 80


def metrics(spark, folder):
    return it.with_month(v.interest_metrics(spark, folder))


def known(spark, folder):
    return v.interest_map(spark, folder).withColumnRenamed("id", "interest_id")


def on_metrics(operator, *args):
    return lambda spark, folder: operator(metrics(spark, folder), *args)


def on_kept(operator, *args):
    return lambda spark, folder: operator(it.kept(metrics(spark, folder), MIN_MONTHS), *args)


def by_month(spark, folder):
    counts = agg.count_rows(metrics(spark, folder), ["month_start"])
    return counts.orderBy(F.col("month_start").asc_nulls_first())


def interests_after_removal(spark, folder):
    dated = it.kept(metrics(spark, folder), MIN_MONTHS).filter(F.col("month_start").isNotNull())
    return agg.distinct_count(dated, ["month_start"], "interest_id", "interests")


def joined(spark, folder):
    return metrics(spark, folder).join(known(spark, folder), "interest_id", "left")


def before_created(spark, folder):
    early = joined(spark, folder).filter(F.col("month_start") < F.col("created_at"))
    return early.select("interest_id", "month_start", "created_at")


def min_max_with_month(spark, folder):
    return it.extremes_of_varied(metrics(spark, folder), "percentile_ranking", MIN_MONTHS, 5)


def most_frequent_top(spark, folder):
    counts = agg.count_rows(it.top_per_month(metrics(spark, folder), 10), ["interest_id"], "months")
    return agg.top_k(counts, "months", 1, ["interest_id"])


def avg_of_top_n(spark, folder):
    sums = it.top_per_month(metrics(spark, folder), 10).groupBy("month_start").agg(
        F.sum("avg_composition").alias("s"), F.count(F.lit(1)).alias("n")
    )
    return sums.select("month_start", it.ratio(F.col("s"), F.col("n"), 2).alias("avg_of_top"))


def register(r: Registry) -> None:
    m = "v_monthly"
    doubles = "cast(composition as double) as composition, cast(index_value as double) as index_value"
    r.add("month_to_date", metrics, m,
          f"select interest_id, month_start, {doubles}, ranking, percentile_ranking from v_monthly")
    r.add("count_by_month_nulls_first", by_month, m, "select month_start, count(*) as n from v_monthly group by 1")
    r.add("missing_both_ways", lambda s, f: it.missing_both_ways(metrics(s, f), known(s, f), "interest_id"),
          m + " v_known", """
select (select count(distinct interest_id) from v_monthly where interest_id not in (select id from v_known)) as only_left,
       (select count(distinct id) from v_known where id not in (select interest_id from v_monthly)) as only_right""")
    r.add("id_record_counts", lambda s, f: agg.count_rows(v.interest_map(s, f), ["id"]), "v_known",
          "select id, count(*) as n from v_known group by 1")
    r.add("joined_lookup", joined, m + " v_known", f"""
select interest_id, month_start, {doubles}, ranking, percentile_ranking, interest_name, created_at
from v_monthly left join v_known on id = interest_id""")
    r.add("month_before_created", before_created, m + " v_known", """
select interest_id, month_start, created_at from v_monthly join v_known on id = interest_id where month_start < created_at""")
    months = "select interest_id, count(distinct month_start) as total_months, count(month_start) as points from v_monthly group by 1"
    r.add("in_all_months", on_metrics(it.in_all_months), m, f"""
select interest_id, total_months from ({months}) t
where total_months = (select count(distinct month_start) from v_monthly)""")
    r.add("cumulative_pct", on_metrics(it.cumulative_percent), m, f"""
select total_months, interests, {sql_ratio('sum(interests) over (order by total_months desc)', 'sum(interests) over ()', 2, 100)}
         as cumulative_percent
from (select total_months, count(*) as interests from ({months}) t group by 1) u""")
    r.add("points_removed", on_metrics(it.points_removed, MIN_MONTHS), m, f"""
select cast(coalesce(sum(points), 0) as bigint) as points_removed from ({months}) t where total_months < {MIN_MONTHS}""")
    keep = f"""kept as (select * from v_monthly where interest_id in
                 (select interest_id from ({months}) t where total_months >= {MIN_MONTHS}))"""
    r.add("interests_after_removal", interests_after_removal, m, f"""
with {keep} select month_start, count(distinct interest_id) as interests from kept where month_start is not null group by 1""")
    r.add("top_bottom_n_max", lambda s, f: it.top_and_bottom(
        it.maximum_per_interest(it.kept(metrics(s, f), MIN_MONTHS)), "composition", "interest_id", 10), m, f"""
with {keep}, best as (select interest_id, cast(composition as double) as composition, month_start from
       (select *, row_number() over (partition by interest_id order by composition desc, month_start) as rn
        from kept where month_start is not null) t where rn = 1)
(select *, 'top' as side from best order by composition desc, interest_id limit 10)
union all (select *, 'bottom' from best order by composition, interest_id limit 10)""")
    r.add("lowest_avg", on_kept(it.lowest_average, "ranking", 5), m, f"""
with {keep} select interest_id, {sql_ratio('sum(ranking)', 'count(*)', 4)} as avg_ranking from kept group by 1
order by 2, 1 limit 5""")
    spread = "select interest_id, round(stddev(percentile_ranking), 6) as deviation from kept group by 1 order by 2 desc, 1 limit 5"
    r.add("largest_stddev", on_kept(it.largest_deviation, "percentile_ranking", 5), m, f"with {keep} {spread}")
    r.add("min_max_with_month", min_max_with_month, m, f"""
with {keep}, dated as (select k.* from kept k join ({spread}) s using (interest_id) where month_start is not null)
select interest_id, min(percentile_ranking) as min_value,
       first(month_start order by percentile_ranking, month_start) as min_month,
       max(percentile_ranking) as max_value,
       first(month_start order by percentile_ranking desc, month_start) as max_month
from dated group by 1""")
    value = sql_ratio("composition", "index_value", 2)
    r.add("avg_composition", on_metrics(it.average_composition), m, f"""
select interest_id, month_start, {doubles}, ranking, percentile_ranking, {value} as avg_composition from v_monthly""")
    valued = f"valued as (select interest_id, month_start, {value} as avg_composition from v_monthly where month_start is not null)"
    top = f"""{valued}, top as (select month_start, interest_id, avg_composition, cast(rk as int) as rank from
       (select *, rank() over (partition by month_start order by avg_composition desc) as rk from valued) t where rk <= 10)"""
    r.add("top_n_per_month", on_metrics(it.top_per_month, 10), m, f"with {top} select * from top")
    r.add("most_frequent_top", most_frequent_top, m, f"""
with {top} select interest_id, count(*) as months from top group by 1 order by 2 desc, 1 limit 1""")
    r.add("avg_of_top_n", avg_of_top_n, m, f"""
with {top} select month_start, {sql_ratio('sum(cast(avg_composition as decimal(18,2)))', 'count(*)', 2)} as avg_of_top
from top group by 1""")
    r.add("rolling3_with_previous", on_metrics(it.leaders_with_previous), m, f"""
with {valued}, leaders as (select month_start, interest_id, avg_composition as max_value from
   (select *, row_number() over (partition by month_start order by avg_composition desc, interest_id) as rn from valued) t
   where rn = 1)
select month_start, interest_id, max_value,
       {sql_ratio('sum(cast(max_value as decimal(18,2))) over w3', 'count(*) over w3', 2)} as rolling_3_months,
       lag(interest_id, 1) over w as leader_1_before, lag(max_value, 1) over w as value_1_before,
       lag(interest_id, 2) over w as leader_2_before, lag(max_value, 2) over w as value_2_before
from leaders window w as (order by month_start), w3 as (order by month_start rows between 2 preceding and current row)""")
