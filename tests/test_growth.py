"""Operators for keys and tables of any size, against brute force."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tallywork.operators import percentiles as pc
from tallywork.operators import sketches as sk
from tallywork.operators import slices as sl
from tallywork.operators.histories import as_of
from tallywork.operators.ranges import in_intervals
from tallywork.plans import growth
from tallywork.sources import tables as tb


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one key; NULL keys, NULL values, ties."""
    dice = random.Random(2)
    rows = [(dice.choice(["hot", "hot", *"abcdef", None]), dice.randint(0, 90) / 4 if dice.random() < 0.9 else None, i) for i in range(1500)]
    return spark.createDataFrame(rows, "k string, v double, i long").repartition(6).cache()


def in_duckdb(df, sql):
    rows = df.collect()
    con = duckdb.connect()
    con.execute("create table t (k varchar, v double, i bigint)")
    con.executemany("insert into t values (?, ?, ?)", [tuple(r) for r in rows])
    return sorted(con.execute(sql).fetchall(), key=str)


@pytest.mark.parametrize("slices", [1, 9])
def test_percentiles_per_key(skewed, slices):
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    columns = ", ".join(f"quantile_cont(v, {p}), quantile_disc(v, {p})" for p in shares.values())
    want = in_duckdb(skewed, f"select k, count(v), {columns} from t where v is not null group by k")
    got = pc.percentiles(skewed, ["k"], "v", shares, slices)
    assert [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in sorted_rows(got)] == [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in want]
    assert pc.percentiles(skewed.filter("v < -1"), ["k"], "v", shares).collect() == []


def test_percentile_slices_are_even(skewed):
    """The hot key's values lie in many slices, and no slice is far larger than another."""
    distinct = skewed.select(F.col("i").cast("double").alias("v")).withColumn("k", F.lit("hot"))
    sizes = [r["count"] for r in sl.in_slices(distinct, ["k"], ["v"], 10).groupBy("_slice").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 1500 / 10


def test_quantile_sketches_merge(spark):
    values = spark.range(20_000).select((F.col("id") % 10).alias("day"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"))
    found = pc.merged_quantiles(pc.quantile_sketches(values, ["day"], "v"), [], {"p50": 0.5, "p99": 0.99}).first()
    for name, share in (("p50", 0.5), ("p99", 0.99)):
        rank = values.filter(F.col("v") <= found[f"{name}_approx"]).count() / 20_000
        assert abs(rank - share) <= 2 * pc.kll_error()
    assert found["rows"] == 20_000


def test_distinct_sketches_merge(spark):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 3).alias("shop"), (F.col("id") % 20_011).alias("user"))
    parts = sk.distinct_sketches(rows, ["month", "shop"], "user")
    assert parts.count() == 12
    for keys in ([], ["shop"], ["month"]):
        exact = {tuple(r)[:-1]: r["n"] for r in rows.groupBy(*keys).agg(F.countDistinct("user").alias("n")).collect()}
        for r in sk.merged_distinct(parts, keys, "n").collect():
            assert abs(r["n"] - exact[tuple(r)[:-1]]) <= sk.distinct_error() * exact[tuple(r)[:-1]]


def test_bitmaps_add_up(spark):
    dice = random.Random(6)
    rows = [(dice.choice(["x", "y", None]), dice.randint(0, 3), dice.choice([None, dice.randint(0, 70_000), 5])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a string, b int, id long").repartition(5)
    want = {}
    for mask in range(4):
        for a, b, i in rows:
            if i is not None:
                want.setdefault((None if mask & 2 else a, None if mask & 1 else b, mask), set()).add(i)
    assert {tuple(r)[:-1]: r["n"] for r in sk.cube_distinct(df, ["a", "b"], "id", "n").collect()} == {k: len(v) for k, v in want.items()}


def test_division(spark):
    df = spark.createDataFrame([("all", x) for x in (1, 40_000, 7, 7, 9)] + [("some", 1), ("some", 7), ("other", 40_000), (None, 1)], "k string, x long")
    every = spark.createDataFrame([(1,), (40_000,), (7,)], "x long")
    assert [tuple(r) for r in sk.divided(df, "k", "x", every, "n").collect()] == [("all", 4)]


@pytest.mark.parametrize("rows,before,after", [(40, 3, 2), (1, 0, 5), (7, 12, 0)])
def test_rows_frames_of_a_hot_key(skewed, rows, before, after):
    got = sl.rows_frame(skewed, ["k"], ["i"], {"s": F.sum("v"), "m": F.max("v"), "c": F.count("v")}, before, after, rows)
    want = in_duckdb(skewed, f"select k, v, i, sum(v) over w, max(v) over w, count(v) over w from t window w as (partition by k order by i rows between {before} preceding and {after} following)")
    assert sorted_rows(got) == want


def test_running_frame_and_numbers(skewed):
    got = sl.running_frame(skewed, ["k"], ["i"], F.col("v"), "s")
    assert sorted_rows(got.select("k", "i", "s")) == in_duckdb(skewed, "select k, i, coalesce(sum(v) over (partition by k order by i), 0) from t")
    numbered = sl.numbered(sl.in_slices(skewed, ["k"], ["v", "i"], 7), ["k"], ["v", "i"], "n")
    assert sorted_rows(numbered.select("k", "i", "n")) == in_duckdb(skewed, "select k, i, row_number() over (partition by k order by v nulls last, i) from t")


@pytest.mark.parametrize("inclusive", [True, False])
def test_as_of_two_histories(spark, inclusive):
    dice = random.Random(8)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n) if n is not None else None
    facts = [(dice.choice(["hot", "hot", "a", "b", None]), day(dice.choice([None, *range(30)])), i) for i in range(300)]
    history = [(dice.choice(["hot", "a", None]), day(dice.choice([None, *range(0, 30, 3)])), i, dice.choice([None, i * 2])) for i in range(60)]
    left = spark.createDataFrame(facts, "k string, at date, fact long").repartition(5)
    right = spark.createDataFrame(history, "k string, since date, tie long, price long").repartition(3)
    want = []
    for k, at, fact in facts:
        known = [(s, t, p) for hk, s, t, p in history if hk == k and s is not None and at is not None and (s < at or inclusive and s == at)]
        best = max(known, key=lambda x: x[:2], default=None)
        want.append((k, at, fact, best[2] if best else None))
    got = as_of(left, right, ["k"], "at", "since", ["price"], "tie", "fact", inclusive)
    assert got.columns == ["k", "at", "fact", "price"] and sorted_rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("closed,per_bin", [(True, 20), (False, 20), (True, 100_000)])
def test_points_in_intervals(spark, closed, per_bin):
    """Most points share one value, so their bin is split; long, open and turned intervals."""
    dice = random.Random(7)
    points = [(i, 500 if i % 3 else dice.randint(0, 1000)) for i in range(400)] + [(900, None)]
    spans = [(j, s := dice.randint(-50, 1050), s + dice.randint(-5, 40)) for j in range(120)] + [(200, 0, None), (201, -100, 5000), (202, None, 7), (203, 500, 500)]
    found = in_intervals(spark.createDataFrame(points, "p long, x int"), spark.createDataFrame(spans, "j long, lo int, hi int"), "x", "lo", "hi", closed, per_bin)
    want = [(p, x, j, lo, hi) for p, x in points for j, lo, hi in spans if x is not None and lo is not None and lo <= x and (hi is None or (x <= hi if closed else x < hi))]
    assert sorted_rows(found) == sorted(want, key=str)


def test_times_in_intervals_and_nothing(spark):
    at = lambda m: dt.datetime(2024, 5, 1) + dt.timedelta(minutes=m)
    points = spark.createDataFrame([(i, at(i * 7)) for i in range(50)], "p long, x timestamp")
    spans = spark.createDataFrame([(j, at(j * 30), at(j * 30 + 20)) for j in range(12)], "j long, lo timestamp, hi timestamp")
    found = in_intervals(points, spans, "x", "lo", "hi", per_bin=5)
    assert found.count() == sum(j * 30 <= i * 7 <= j * 30 + 20 for i in range(50) for j in range(12))
    assert in_intervals(points.limit(0), spans, "x", "lo", "hi").collect() == [] == in_intervals(points, spans.limit(0), "x", "lo", "hi").collect()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_join_is_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(growth.sales_in_campaigns(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text


def files(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, "c", 40), (5, None, 50)], "id long, part string, x int")
    tb.append_rows(df, path, ["part"])
    first = files(path)
    tb.append_rows(spark.createDataFrame([(6, "b", 60)], "id long, part string, x int"), path, ["part"])
    second = files(path)
    assert first.items() <= second.items() and len(second) == len(first) + 1
    changed = tb.rewrite_where(spark, path, ["part"], F.col("x") > 35, {"x": F.col("x") + 1})
    assert sorted(tuple(r) for r in changed.select("id", "x").collect()) == [(1, 10), (2, 20), (3, 30), (4, 41), (5, 51), (6, 61)]
    kept = {k: t for k, t in second.items() if k.startswith("part=a/")}
    assert kept.items() <= files(path).items()
    assert not any(k in files(path) for k in second if k.startswith("part=b/"))
    tb.replace_partitions(spark.createDataFrame([(9, "c", 1)], "id long, part string, x int"), path, ["part"])
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        tb.rewrite_where(spark, path, ["part"], F.col("x") > 0, {"part": F.lit("z")})


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(1000).select((F.col("id") % 300).alias("txn_id"), F.lit(Decimal("1.50")).alias("price"))
        orders = spark.range(300).select(F.col("id").alias("txn_id"), (F.col("id") % 3).cast("string").alias("status"), F.lit(Decimal("5.00")).alias("amount"))
        left = tb.store_bucketed(lines, "growth_lines", str(tmp_path / "l"), ["txn_id"], 5)
        right = tb.store_bucketed(orders, "growth_orders", str(tmp_path / "o"), ["txn_id"], 5)
        found = growth.margins(left, right)
        text = plan_of(found)
        assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("Join")  # of the last grouping alone
        assert sum(r["orders"] for r in found.collect()) == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists growth_lines")
        spark.sql("drop table if exists growth_orders")
