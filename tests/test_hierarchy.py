from __future__ import annotations

import random

import pytest

from tallywork.operators.hierarchy import depths, paths

SCHEMA = "id long, parent_id long, level_text string"


def test_more_levels_than_any_fixed_depth(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, f"n{i}") for i in range(55)], SCHEMA)
    deepest = paths(chain.coalesce(1), "/").orderBy("depth", ascending=False).first()
    assert (deepest.id, deepest.root_id, deepest.depth) == (54, 0, 55) and deepest.path.endswith("/n53/n54")


def test_a_cycle_is_an_error(spark):
    looped = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (2, 3, "b")], SCHEMA)
    with pytest.raises(Exception, match="cycle at node 2"):
        paths(looped).count()


def test_nodes_without_root_have_no_path(spark):
    orphans = spark.createDataFrame([(1, None, "a"), (5, 6, "x"), (6, 5, "y")], SCHEMA)
    assert [r.id for r in paths(orphans).collect()] == [1]


def test_a_thousand_levels_in_ten_rounds(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, f"n{i}") for i in range(1000)] + [(5000 + i, 500, "leaf") for i in range(50)], SCHEMA)
    found, rounds = depths(chain)
    assert rounds == 10 and found.agg({"depth": "max"}).first()[0] == 1000
    leaf = paths(chain, "/").filter("id = 5007").first()
    assert leaf.depth == 502 and leaf.path == "/".join(f"n{i}" for i in range(501)) + "/leaf"


def test_random_forest_against_walks(spark):
    dice = random.Random(3)
    parent = {i: dice.randrange(i) if i > 3 else None for i in range(300)}
    found = {r.id: (r.root_id, r.depth, r.path) for r in paths(spark.createDataFrame([(i, p, str(i)) for i, p in parent.items()], SCHEMA), ".").collect()}
    for i in parent:
        walk = [i]
        while parent[walk[-1]] is not None:
            walk.append(parent[walk[-1]])
        assert found[i] == (walk[-1], len(walk), ".".join(map(str, walk[::-1])))


def test_two_parents_give_two_paths_and_nothing_comes_of_nothing(spark):
    both = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, 1, "c"), (3, 2, "c"), (4, 3, "d"), (4, 9, "d")], SCHEMA)
    assert sorted(r.path for r in paths(both, "").collect()) == ["a", "ac", "acd", "b", "bc", "bcd"]
    assert paths(both.limit(0)).collect() == []
