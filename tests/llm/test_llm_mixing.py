from __future__ import annotations

import math

import pytest
from compare import check, connect

from conftest_llm import clashing, same, words
from tallywork.llm import mixing
from tallywork.llm.queries import CHECKS, QUERIES

WEIGHTS = [5.0, 2.0, 1.0]


def water(sizes, weights, most):
    """Targets by sharing the excess again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while free and left > 1e-9:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        stop = {s for s in free if share[s] >= most * sizes[s]}
        for s in stop or free:
            target[s] = most * sizes[s] if stop else share[s]
        left -= sum(target[s] for s in (stop or free))
        free -= stop or free
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_are_those_of_repeated_sharing(spark, seed):
    import random

    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 400, 9000]) for i in range(rng.randint(1, 9))} | ({None: 30} if seed % 2 else {})
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), WEIGHTS, 3.0)
    want = water(sizes, WEIGHTS, 3.0)
    for r in found.collect():
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)


def test_against_sql(spark, folder):
    assert check(QUERIES["op8_mixing"], CHECKS["op8_mixing"], spark, folder, connect(folder)) is None
    plan = QUERIES["op8_mixing"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_odd_rows(odd, nothing):
    mixed = mixing.mix(odd, WEIGHTS)
    got = mixed.collect()
    assert len(got) == odd.count()
    sizes = {}
    for r in odd.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    want = water(sizes, WEIGHTS, 3.0)
    for r in got:
        assert r.size == len(words(r.text)) and r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    assert len({(r.copies) for r in got if r.doc_id == 7}) == 1
    assert same(mixed, mixing.mix(clashing(odd, "Size", "target", "taken"), WEIGHTS))
    assert mixing.repeated(mixed).count() == sum(r.copies for r in got)
    assert mixing.mix(nothing, WEIGHTS).count() == 0


def test_taken_comes_near_the_target(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text", "concat('s', id % 3) as source")
    sums = mixing.mix(docs, WEIGHTS).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.05 for r in sums)
