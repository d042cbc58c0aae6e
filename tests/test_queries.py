"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import re

import pytest
from compare import check, connect

import __spark_entry__ as entry
from tallywork.plans.catalog import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = registry().queries, registry().checks

# Nodes a plan must not contain: pairs of all rows, and Python in the hot path.
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups")

# On the smallest tables no row comes out of these; they are held against larger ones.
NEEDS_MORE = {"points_first_week", "in_all_months", "interests_after_removal", "top_bottom_n_max", "lowest_avg",
              "largest_stddev", "min_max_with_month", "basket_k_items", "active_customers_by_month",
              "active_customers_by_month_pivot", "active_customers_by_month_text"}
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    where, con = (LARGER, connect(LARGER)) if name in NEEDS_MORE else (FOLDER, con)
    assert check(QUERIES[name], CHECKS[name], spark, where, con) is None
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.search(plan)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "total_sales"] and df.count() > 0
