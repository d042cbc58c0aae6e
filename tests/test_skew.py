"""The sliced operators against plain windows, with a hot key, NULLs and ties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywork.operators import skew


@pytest.fixture(scope="module")
def facts(spark):
    """One key with half of all rows, a NULL key, many ties in ``day``."""
    rng = random.Random(7)
    keys = ["hot"] * 300 + [None] * 40 + [f"k{i % 37}" for i in range(260)]
    rows = [(k, rng.randrange(40), i, rng.randrange(1, 100)) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "key string, day int, id int, value int").cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def holes(facts):
    """The facts with NULL days and NULL ids."""
    return facts.withColumns(
        {"day": F.when(F.col("day") % 7 != 3, F.col("day")), "id": F.when(F.col("id") % 601 != 5, F.col("id"))}
    ).cache()


def by_day_and_id():
    return Window.partitionBy("key").orderBy(F.col("day").asc_nulls_last(), F.col("id").asc_nulls_last())


@pytest.mark.parametrize("slices", [["day"], ["day", "id"]])
def test_row_numbers(holes, slices):
    plain = holes.withColumn("n", F.row_number().over(by_day_and_id()))
    got = skew.number_rows(holes, ["key"], ["day", "id"], "n", [F.col(c) for c in slices])
    assert rows(got.select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("slices", [["day"], ["day", "id"]])
@pytest.mark.parametrize("forward", [True, False])
def test_lead_and_lag(holes, slices, forward):
    step = F.lead if forward else F.lag
    window = by_day_and_id()
    plain = holes.withColumns({"other": step("value").over(window), "when": step("day").over(window)})
    cuts = [F.floor(F.col(c) / 5) for c in slices]
    cuts = cuts[:1] if len(cuts) == 1 else [F.col("day"), F.floor(F.col("id") / 50)]
    got = skew.shift_rows(holes, ["key"], ["day", "id"], {"other": "value", "when": "day"}, cuts, forward)
    assert rows(got.select(plain.columns)) == rows(plain)


def test_running_total_has_the_range_frame(facts):
    plain = facts.withColumn("total", F.sum("value").over(Window.partitionBy("key").orderBy("day")))
    got = skew.running_total(facts, ["key"], "day", F.col("value"), "total")
    assert rows(got.select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("dense", [True, False])
def test_ranks(facts, descending, dense):
    order = F.col("day").desc() if descending else F.col("day").asc()
    rank = F.dense_rank if dense else F.rank
    plain = facts.withColumn("r", rank().over(Window.partitionBy("key").orderBy(order)))
    got = skew.value_rank(facts, ["key"], "day", "r", descending, dense)
    assert rows(got.select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, facts, hot_rows, how):
    names = spark.createDataFrame([("hot", "a"), ("k1", "b"), ("k1", "c"), ("none", "d")], "key string, name string")
    got = skew.join_salted(facts, names, ["key"], how, hot_rows, salts=7)
    want = facts.join(names, "key", how)
    assert rows(got.select(want.columns)) == rows(want)


def test_hot_keys(facts):
    assert rows(skew.hot_keys(facts, ["key"], 30)) == [("hot",), (None,)]


def test_empty(facts):
    nothing = facts.filter(F.lit(False))
    assert skew.number_rows(nothing, ["key"], ["day"], "n", [F.col("day")]).count() == 0
    assert skew.shift_rows(nothing, ["key"], ["day"], {"x": "value"}, [F.col("day")]).count() == 0


def test_full_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (3, "y"), (None, "z")], "k int, r string")
    assert rows(skew.full_join(left, right, ["k"])) == sorted([(1, "a", None), (2, "b", "x"), (3, None, "y"), (None, "n", "z")], key=str)
