from __future__ import annotations

import re

import public_tokenizers
from conftest_llm import clashing, words
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tallywork.llm import mixing, simhash, toxicity
from tallywork.llm.common import written

FOLDER = "/root/testdata/sf0.01"


def test_each_stage_works_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(written(stage(spark, seen[-1], FOLDER), name))
    for kept in seen[1:-1]:
        assert kept.schema.names == docs.schema.names
    whole, clean, distinct, apart, mixed = [[(r.doc_id, r.text, r.source) for r in df.collect()] for df in seen[:5]]
    toxic = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).filter("predicted = 1").collect()}
    assert toxic and sorted(clean) == sorted(r for r in whole if r[0] not in toxic)
    least = {}
    for doc_id, text, _ in sorted(clean):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
    assert sorted(distinct) == sorted(r for r in clean if r[0] in set(least.values())) and len(distinct) < len(clean)
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(seen[2]).collect()}
    assert sorted(apart) == sorted(r for r in distinct if group[r[0]] == r[0]) and len(apart) < len(distinct)
    copies = {r.doc_id: r.copies for r in mixing.mix(seen[3], cp.WEIGHTS).collect()}
    assert sorted(mixed) == sorted(r for r in apart for _ in range(copies[r[0]]))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(text, add_special_tokens=False).ids) + 1 for _, text, _ in mixed)
    assert seen[5].groupBy().sum("length").first()[0] == want
    assert cp.run(spark, FOLDER).groupBy().sum("length").first()[0] == want


def test_stages_on_odd_rows(spark, odd, nothing):
    labels = "/root/testdata/sf0.001"
    for stage_docs in (odd, nothing, clashing(odd, "kept", "score", "copies", "component_id")):
        now = stage_docs
        for name, stage in cp.STAGES:
            now = written(stage(spark, now, labels), name)
        ids = {r.doc_id for r in now.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in odd.collect()}
    assert words(None) == []
