from __future__ import annotations

import shutil
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from compare import check, connect
from conftest_llm import clashing, same
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywork.llm import license_scan, neighbours, token_files
from tallywork.llm.common import new_folder
from tallywork.llm.queries import CHECKS, QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- token files


def index_of(rows):
    """What files with these (doc_id, text) rows, in order, must say."""
    tokenizer, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_of_a_whole_table(spark, folder, rows):
    got = QUERIES["op7_token_files"](spark, folder).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == index_of(sorted((r.doc_id, r.text) for r in rows))


def test_files_are_sorted_and_indexed(spark, docs):
    where = new_folder(spark, "test-files")
    token_files.write_ids(docs, where, WORDS, 1)
    files = [r.f for r in spark.read.orc(where).select(F.input_file_name().alias("f")).distinct().orderBy("f").collect()]
    last = None
    for name in files:
        table = orc.ORCFile(name.removeprefix("file://"))
        ids = table.read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids) and (last is None or last < ids[0])
        last = ids[-1]
    one = spark.read.orc(where).filter("doc_id = 17")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1


def test_files_of_odd_rows(spark, odd, nothing):
    where = new_folder(spark, "odd-files")
    token_files.write_ids(clashing(odd, "ids", "file"), where, WORDS, 1)
    got = token_files.read_index(spark, where).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, len(index_of([r])) and index_of([r])[0][2:]))
    assert [tuple(r) for r in got] == index_of(rows)
    empty = new_folder(spark, "no-files")
    token_files.write_ids(nothing, empty, WORDS, 1)
    assert token_files.read_index(spark, empty).count() == 0


def test_files_count_by_their_ids_not_their_names(spark, tmp_path, docs):
    """Names of six digits sort before those of five; so do copies of one id keep their order."""
    one = docs.orderBy("doc_id").limit(60)
    where = tmp_path / "joined"
    where.mkdir()
    for number, part in ((99999, one.filter("doc_id < 20")), (100000, one.filter("doc_id >= 20").union(one.filter("doc_id = 30").withColumn("text", F.lit("later copy"))))):
        own = tmp_path / str(number)
        token_files.write_ids(part.coalesce(1), str(own), WORDS, 1)
        for i, file in enumerate(sorted(own.glob("part-*.orc"))):
            shutil.copy(file, where / f"part-{number + i:05d}-x.orc")
    rows = [(r.doc_id, r.text) for r in one.collect()] + [(30, "later copy")]
    rows.sort(key=lambda r: (r[0], len(r[1] or "")))
    got = [tuple(r) for r in token_files.read_index(spark, str(where)).orderBy("start").collect()]
    assert got == index_of(rows)
    stored = {(r.doc_id, r.copy): list(r.ids) for r in spark.read.orc(str(where)).collect()}
    at = {r[1]: r for r in got}
    assert len(stored[30, 0]) < len(stored[30, 1]) and zlib.crc32(np.array(stored[30, 1], "<u4").tobytes()) == at[max(s for s, r in at.items() if r[0] == 30)][3]


def test_a_bloom_filter_keeps_a_stripe_from_being_read(spark, docs):
    """An id between the smallest and the largest that no document has: no row leaves the scan."""
    where = new_folder(spark, "pruned-files")
    token_files.write_ids(docs.withColumn("doc_id", F.col("doc_id") * 2).coalesce(1), where, WORDS, 1)

    def read(doc_id):
        asked = spark.read.orc(where).filter(F.col("doc_id") == doc_id)
        found = len(asked.collect())
        scan = asked._jdf.queryExecution().executedPlan().collectLeaves().head()
        return found, scan.metrics().apply("numOutputRows").value()

    hits = [read(2 * i) for i in (3, 50, 77)]
    misses = [read(2 * i + 1) for i in (3, 50, 77, 90, 120)]
    assert all(found == 1 and scanned >= 1 for found, scanned in hits)
    assert sum(scanned == 0 for _, scanned in misses) >= 4 and not any(found for found, _ in misses)


# --- neighbours


def brute(ids, vectors, asked, k):
    out = {}
    for q in asked:
        own = np.flatnonzero(ids == q)[0]
        scores = (vectors * vectors[own]).sum(axis=1)
        scores[ids == q] = -np.inf
        order = np.lexsort((ids, -scores))[: min(k, int((ids != q).sum()))]
        out[int(q)] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    got, want = found(QUERIES["op3_neighbours"](spark, folder)), brute(ids, vectors, ids[ids % 20 == 0], 20)
    assert set(got) == set(want)
    hits = 0
    for q, near in got.items():
        exact = (vectors * vectors[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        by_id = dict(zip(ids.tolist(), exact.tolist()))
        assert all(abs(by_id[v] - s) < 1e-12 for v, s in near) and near == sorted(near, key=lambda x: (-x[1], x[0]))
        hits += len({v for v, _ in near} & {v for v, _ in want[q]})
    assert hits / sum(map(len, want.values())) >= 0.9


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(40)] + [(100 + i, rng.standard_normal(3).tolist()) for i in range(10)]
    bad = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 1.0]), (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0]), (300, []), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = found(neighbours.searched(clashing(table, "score", "leaf", "vec"), F.col("vec_id") % 20 == 0, 60))
    ids = np.array([i for i, _ in rows])
    vectors = np.array([np.array(v, np.float32).astype(float) for _, v in rows])
    assert got == brute(ids, vectors, [0, 20, 100], 60) and len(got[0]) == len(rows) - 1
    few = found(neighbours.searched(table, F.col("vec_id") % 20 == 0, 5))
    assert [v for v, _ in few[0]] == [v for v, _ in brute(ids, vectors, [0], 5)[0]]
    assert neighbours.searched(table.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_walk_reaches_every_leaf_best_first():
    vectors = np.random.default_rng(1).standard_normal((600, 8))
    tree = neighbours.grow(vectors)
    leaves = sum(leaf >= 0 for leaf in tree.leaf)
    order = list(tree.visits(vectors[3], leaves))
    assert sorted(order) == list(range(leaves)) and set(tree.home(vectors)) == set(range(leaves))
    assert list(tree.visits(vectors[3], 4)) == order[:4] and tree.home(vectors[3:4])[0] in order[: leaves // 2]


# --- licences


def test_licences_against_sql(spark, folder):
    assert check(QUERIES["op9_license_scan"], CHECKS["op9_license_scan"], spark, folder, connect(folder)) is None
    plan = QUERIES["op9_license_scan"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


@pytest.fixture(scope="module")
def notices(spark):
    long = " ".join(f"t{i}" for i in range(40))
    return spark.createDataFrame([("long", long), ("short", "All rights."), ("none", None), ("blank", " .,")], "template_id string, text string")


def test_licences_with_changes(spark, notices):
    whole = [f"t{i}" for i in range(40)]
    few, many = list(whole), list(whole)
    few[20] = "x"
    for i in (5, 15, 25, 35):
        many[i] = "x"
    texts = {1: "lead " * 33 + " ".join(whole).upper() + " tail" * 9, 2: " ".join(few), 3: " ".join(many), 4: "all\n rights, reserved", 5: "t1 t2 t3 t4 t5", 6: (" ".join(whole) + " z ") * 3}
    got = {(r.doc_id, r.template_id): r for r in license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), notices).collect()}
    assert set(got) == {(1, "long"), (2, "long"), (4, "short"), (6, "long")}
    assert got[1, "long"].containment == 1.0 and 16 <= got[1, "long"].at_word <= 33 and 0.8 <= got[2, "long"].containment < 1 and got[6, "long"].windows >= 3


def test_licences_in_odd_rows(odd, nothing, notices):
    assert license_scan.scan(odd, notices).count() == license_scan.scan(nothing, notices).count() == 0
    assert license_scan.scan(odd, notices.filter("false")).count() == 0
    marked = odd.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" all rights")))
    found_rows = license_scan.scan(clashing(marked, "words", "hashes", "start", "template_id"), notices)
    assert same(found_rows, license_scan.scan(marked, notices)) and {r.doc_id for r in found_rows.collect()} == {r.doc_id for r in odd.collect()}


def test_standard_list_knows_common_licences(spark):
    """Variants of short notices, headers and openings, within other text."""
    texts = {
        "mit/licensed": "My tool. Licensed under the MIT License, enjoy.", "apache-2.0/name": "It uses the Apache License 2.0 throughout.",
        "apache-2.0/header": "# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n# http",
        "lgpl": "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either",
        "agpl-3.0": "modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3",
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc0-1.0/name": "Dedicated under CC0 1.0 Universal now",
        "unlicense": "This is free and unencumbered software released into the public domain.",
    }
    docs = spark.createDataFrame([*texts.items(), ("none", "A plain text about the license of a driver, with nothing else.")], "doc_id string, text string")
    found = {(r.doc_id, r.template_id) for r in license_scan.scan(docs, license_scan.standard(spark)).collect()}
    assert {(name, name) for name in texts} <= found and not any(doc_id == "none" for doc_id, _ in found)


def test_neighbours_of_a_sampled_tree_in_shards_and_blocks(spark):
    """A tree of a part of the vectors, many shards of a leaf, several blocks of queries."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    asked = [i for i in ids.tolist() if i % 4 == 0]
    got = neighbours.searched(table, F.col("vec_id") % 4 == 0, 10, sample_rows=400, shard_rows=16, shard_queries=7).collect()
    want = brute(ids, vectors, asked, 10)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == set(asked) and all(sorted(x) == list(range(1, 11)) for x in found.values())
    hits = sum(len({v for v, _ in found[q].values()} & {v for v, _ in want[q]}) for q in asked)
    assert hits / (10 * len(asked)) >= 0.9
    whole = neighbours.searched(table, F.col("vec_id") % 4 == 0, 10, recall=1.0, sample_rows=400, shard_rows=16, shard_queries=7)
    assert len(whole.collect()) == 10 * len(asked)


def test_vectors_of_other_lengths_take_no_part(spark):
    data = [(i, [float(i % 7), 1.0, 2.0]) for i in range(40)] + [(100 + i, [1.0, 2.0]) for i in range(10)] + [(200, [5.0, 5.0, 5.0, 5.0])]
    got = neighbours.searched(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, 3).collect()
    assert {r.query_id for r in got} == {0, 20} and all(r.vec_id < 40 for r in got)
