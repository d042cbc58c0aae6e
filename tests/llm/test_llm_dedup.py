from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from compare import check, connect
from conftest_llm import clashing, same, words

from tallywork.llm import components, exact_dedup, simhash
from tallywork.llm.queries import CHECKS, QUERIES


def test_exact_against_sql(spark, folder):
    assert check(QUERIES["op6_exact_dedup"], CHECKS["op6_exact_dedup"], spark, folder, connect(folder)) is None


def test_exact_odd_rows(odd, nothing):
    found = exact_dedup.exact_groups(odd, table_bytes=50_000)
    groups = {}
    for r in odd.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    got = found.collect()
    assert len(got) == odd.count()
    for r in got:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        least = min((x for x in groups[text] if x is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(groups[text]), r.doc_id == least)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    more = clashing(odd, "keep_id", "Kept", "digest", "length", "hashed")
    assert same(found, exact_dedup.exact_groups(more))
    assert exact_dedup.exact_groups(nothing).count() == 0


@pytest.mark.parametrize("table_bytes", [400, 20_000, 10**9])
def test_spilling_changes_nothing(table_bytes):
    rng = random.Random(2)
    texts = [b"%d " % rng.randrange(900) * 40 for _ in range(4000)]
    records = [(hashlib.sha256(t).hexdigest(), xxhash.xxh64_intdigest(t) >> 1, t, 1, i) for i, t in enumerate(texts)]
    found = list(exact_dedup.groups(iter(records), table_bytes))
    want = {}
    for i, t in enumerate(texts):
        count, least = want.get(t, (0, i))
        want[t] = (count + 1, least)
    assert len(found) == len(want) and {r[2]: (r[3], r[4]) for r in found} == want
    merged = list(exact_dedup.combined(iter(records), table_bytes))
    assert sum(r[3] for r in merged) == len(texts)


def test_equal_hashes_with_different_contents():
    """The complete content decides, whatever the hash says."""
    records = [("d" * 64, 5, b"%d" % (i % 3), 1, i) for i in range(9)]
    assert sorted((r[2], r[3], r[4]) for r in exact_dedup.groups(iter(records), 10)) == [(b"0", 3, 0), (b"1", 3, 1), (b"2", 3, 2)]


def plain_fingerprint(text):
    own = words(text)
    shingles = [" ".join(own[i : i + 4]) for i in range(len(own) - 3)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def linked(prints):
    """Component (by position of its first member) of each fingerprint, all pairs compared."""
    fps = np.array(prints, np.uint64)
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4).tolist():
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_simhash_against_all_pairs(spark, folder, rows):
    got = {r.doc_id: r for r in QUERIES["op10_simhash"](spark, folder).collect()}
    rows = sorted(rows, key=lambda r: r.doc_id)
    for r in rows[:80]:
        assert got[r.doc_id].fingerprint == f"{plain_fingerprint(r.text):016x}"
    label = linked([int(got[r.doc_id].fingerprint, 16) for r in rows])
    assert [got[r.doc_id].component_id for r in rows] == [rows[x].doc_id for x in label]


def test_dense_cells_lose_no_link(spark):
    """Chains and clouds of near fingerprints in few cells, against all pairs."""
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for start in prints[:4]:
        now = start
        for _ in range(120):
            now ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.append(now)
            if rng.random() < 0.3:
                now = start
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    cells = simhash.grid(table).repartition(7, "table", "cell").sortWithinPartitions("table", "cell", "fp")
    roots = {r.a: r.b for r in components.components(cells.mapInArrow(simhash.linked, "a long, b long")).collect()}
    label = linked(prints)
    by_root = {}
    for p, x in zip(signed, label):
        by_root.setdefault(roots.get(p, p), set()).add(x)
    assert all(len(v) == 1 for v in by_root.values()) and len(by_root) == len(set(label))


def test_more_fingerprints_take_more_groups():
    assert [simhash.groups_for(n) for n in (0, 10**6, 10**8, 10**9, 10**10, 10**11)] == [7, 7, 7, 8, 9, 10]
    for groups in (7, 8, 9):
        masks = [m & (1 << 64) - 1 for m in simhash.masks(groups)]
        assert len(masks) == math.comb(groups, 4)
        dice = random.Random(groups)
        for _ in range(200):  # four differing segments anywhere: some table has none of them
            changed = sum(3 << 2 * s for s in dice.sample(range(32), 4))
            assert any(not m & changed for m in masks)


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(200, x) for x in range(150, 199)] + [(301, 300)]
    got = {r.a: r.b for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 150 for i in range(151, 199)}, 200: 150, 301: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_odd_rows(odd, nothing):
    found = simhash.near_duplicates(clashing(odd, "fp", "component_id"))
    got = found.collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (9, None)}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == "0" * 16
    assert by_id[1].component_id == by_id[3].component_id == 1 and by_id[7].component_id == by_id[8].component_id == 7
    assert by_id[6].component_id == 5
    kept = simhash.one_of_each(odd).collect()
    # the second row of 7 and the null text without an id are copies; the two texts of 9 are not
    assert sorted((r.doc_id for r in kept), key=str) == [1, 4, 5, 7, 9, 9, None] and kept[0].asDict().keys() == set(odd.columns)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0


def test_a_table_read_in_twice_leaves_one_row_of_each_text(spark, docs, odd):
    odd = odd.withColumn("doc_id", odd["doc_id"] + 1_000_000)
    twice = docs.union(docs).union(odd).union(odd).union(odd)
    found = exact_dedup.one_of_each(twice)
    texts = {re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in twice.collect()}
    rows = found.collect()
    assert found.columns == docs.columns and len(rows) == len(texts)
    least = {}
    for r in twice.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        if r.doc_id is not None:
            least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert all(r.doc_id == least.get(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in rows)
    apart = simhash.one_of_each(twice).collect()
    groups = {r.component_id if r.component_id is not None else r.fingerprint for r in simhash.near_duplicates(twice).collect()}
    # the two texts of one id are groups of one name
    assert len(apart) == len(groups) + 1 and simhash.one_of_each(spark.createDataFrame(apart, docs.schema)).count() == len(apart)
