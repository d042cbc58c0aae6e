from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tallywork.operators import baskets as bk


def brute(lines, names, size):
    """All sets of the largest count, or where that is one the first by name."""
    baskets = defaultdict(set)
    for txn, product in lines:
        if product in names:
            baskets[txn].add(names[product])
    counts = Counter(", ".join(c) for items in baskets.values() for c in combinations(sorted(items), size))
    best = max(counts.values(), default=0)
    return {c: n for c, n in counts.items() if n == best}


def tables(spark, lines, names):
    return spark.createDataFrame(lines, "txn_id long, product_id long").repartition(4), spark.createDataFrame(list(names.items()), "product_id long, product_name string")


@pytest.mark.parametrize("size,wide,seed", [(3, 100, 1), (3, 5, 2), (2, 4, 3), (4, 6, 4)])
def test_most_frequent_sets(spark, size, wide, seed):
    dice = random.Random(seed)
    names = {i: f"item {i % 37:02d}" for i in range(40)}  # some products share a name
    lines = [(t, min(int(dice.expovariate(0.12)), 41)) for t in range(120) for _ in range(dice.randint(1, 9))]
    found = {r[0]: r[1] for r in bk.frequent_sets(*tables(spark, lines, names), size, wide).collect()}
    want = brute(lines, names, size)
    best = max(want.values())
    assert best > 1 and {c: n for c, n in found.items() if n == best} == want and max(found.values()) == best


def test_a_transaction_with_the_whole_catalogue(spark):
    """Its pairs are not listed: 2000 items have two million."""
    dice = random.Random(9)
    names = {i: f"p{i:04d}" for i in range(2000)}
    lines = [(0, i) for i in range(2000)] + [(1 + t, dice.randrange(2000)) for t in range(600) for _ in range(4)]
    lines += [(5000 + t, i) for t in range(3) for i in (7, 70, 700)]
    found = bk.frequent_sets(*tables(spark, lines, names), 3).orderBy("transactions", ascending=False).first()
    assert (found["product_combi"], found["transactions"]) == ("p0007, p0070, p0700", 4)


def test_two_wide_transactions_alone(spark):
    names = {i: f"p{i:02d}" for i in range(20)}
    lines = [(t, i) for t in (1, 2) for i in range(t, t + 12)] + [(3, 1), (4, 19)]
    want = brute(lines, names, 3)
    found = {r[0]: r[1] for r in bk.frequent_sets(*tables(spark, lines, names), 3, 6).collect()}
    assert found == want and set(want.values()) == {2}


def test_sets_that_occur_once_or_never(spark):
    names = {i: f"p{i}" for i in range(10)}
    lines = [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 5), (2, 6), (3, 1)]
    assert {r[0]: r[1] for r in bk.frequent_sets(*tables(spark, lines, names), 3).collect()} == {"p1, p2, p3": 1, "p1, p5, p6": 1}
    assert bk.frequent_sets(*tables(spark, lines, names), 5).collect() == []
    assert bk.frequent_sets(*tables(spark, [(1, 99)], names), 3).collect() == []
