"""Histogram positions against brute force on sorted lists."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywork.operators import percentiles as pc


def half_up(num, den):
    return (2 * num + den) // (2 * den)


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_sliced_positions_and_median(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(300) if i % 3 else 42 for i in range(n)]  # a third of the rows share one value
    df = spark.createDataFrame([(v,) for v in values], "v int")
    located = pc.sliced_positions(pc.histogram(df, [], "v"), "v", slices=16).cache()
    for row in located.collect():
        assert row.below == sum(v < row.v for v in values)
        assert row.n == values.count(row.v) and row.total == n
    ordered = sorted(values)
    middle = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    assert float(pc.median(located, "v", "m").first()[0]) == middle


def test_rank_share(spark):
    rng = random.Random(1)
    values = [rng.randrange(500) for _ in range(901)]
    df = spark.createDataFrame([(v,) for v in values], "revenue int")
    located = pc.sliced_positions(pc.histogram(df, [], "revenue"), "revenue", slices=8)
    got = {r.percentile: int(r.revenue) for r in pc.rank_share_means(located, "revenue", F.lit(901), [25, 50, 75]).collect()}
    want = {}
    for p in (25, 50, 75):
        hits = [v for v in values if half_up(100 * (1 + sum(o < v for o in values)), 901) == p]
        if hits:
            want[p] = half_up(sum(hits), len(hits))
    assert got == want


@pytest.mark.parametrize("sizes", [(1, 2), (3, 100), (777, 1000)])
def test_bands_per_group(spark, sizes):
    rng = random.Random(3)
    groups = {i: [rng.randrange(60) for _ in range(size)] for i, size in enumerate(sizes)}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "region int, days int")
    located = pc.positions(pc.histogram(df, ["region"], "days"), ["region"], "days")
    got = {(r.region, r.percentile): r.avg_days for r in pc.band_means(located, ["region"], "days", [80, 95]).collect()}
    want = {}
    for g, vs in groups.items():
        ordered, n = sorted(vs), len(vs)
        picks = {50: [ordered[(n - 1) // 2], ordered[n // 2]]} if n % 2 == 0 else {50: [ordered[n // 2]]}
        for p in (80, 95):
            picks[p] = [v for i, v in enumerate(ordered, 1) if half_up(100 * i, n) == p]
        for p, hits in picks.items():
            if hits:
                mean = Decimal(sum(hits)) / len(hits)
                want[(g, p)] = mean.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    assert got == want
