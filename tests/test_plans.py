"""Shapes of physical plans as a large cluster would see them (no small tables)."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallywork.operators import skew
from tallywork.sources.tables import cut_lineage, store

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["first_items_ties", "first_after_join", "last_before_join", "top_n_per_month", "churn_after_trial"])
def test_tops_are_cut_before_the_shuffle(plan, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(name))


@pytest.mark.parametrize("name", ["impact_by_dimension", "before_after_years", "before_after_pct_12"])
def test_one_scan_of_the_facts(plan, name):
    assert len(re.findall(r"FileScan parquet \[l_", plan(name))) == 1


@pytest.mark.parametrize("name", ["clean_orders", "list_sizes", "order_changes", "zip_lists", "order_item_label", "ingredient_totals"])
def test_items_are_read_once(plan, name):
    assert len(re.findall(r"FileScan parquet \[l_", plan(name))) == (2 if name == "order_item_label" else 1)


@pytest.mark.parametrize("name", ["next_plan_share", "payments", "recurring_payments", "avg_days_on_node"])
def test_histories_count_no_keys(plan, name):
    assert "_hot" not in plan(name) and "Broadcast" not in plan(name)


def test_only_needed_columns_are_read(plan):
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan("column_bytes")


def test_no_shuffle_for_row_wise_queries(plan):
    for name in ("clean_deliveries", "avg_speed", "recipe_rows"):
        assert "Exchange" not in plan(name)


def test_windows_without_keys_follow_an_aggregate(plan):
    """A single-partition exchange may only carry rows that were added up before."""
    for name in ("sample_median", "cumulative_pct", "rolling3_with_previous"):
        text = plan(name)
        for match in re.finditer(r"Exchange SinglePartition.*\n(.*)", text):
            assert "Aggregate" in match.group(1) or "Project" in match.group(1)


def test_cold_keys_are_not_broadcast_without_bound(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    assert skew.hot_keys(df, ["k"], 5000).count() == 0


def test_source_has_no_shortcuts():
    text = "\n".join(p.read_text() for p in (Path(__file__).parents[1] / "tallywork").rglob("*.py") if "llm" not in p.parts)
    for word in ("localCheckpoint", "crossJoin(", ".collect()", "toPandas", "pandas_udf", "F.udf", ".rdd"):
        assert word not in text


def test_store_and_cut(spark, tmp_path):
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    back = store(df, str(tmp_path / "t"), ["p"])
    assert back.count() == 5 and set(back.columns) == {"id", "p"}
    assert cut_lineage(df).count() == 5
