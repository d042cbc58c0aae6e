"""The corpus pipeline: toxic documents go, copies and near copies go, sources are mixed to their
weights, and what is left is packed into windows. Each stage's result is written as Parquet to
the shared folder and read again, so a lost executor costs a stage's tasks at most."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallywork.llm import exact_dedup, mixing, packing, simhash, toxicity
from tallywork.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WEIGHTS = [5.0, 2.0, 1.0]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; the labels are those of the folder."""
    return toxicity.accepted(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, that of the smallest id, however often the table has it."""
    return exact_dedup.one_of_each(docs.select(COLUMNS))


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, that of the smallest id."""
    return simhash.one_of_each(docs.select(COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeated(mixing.mix(docs.select(COLUMNS), WEIGHTS)).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a window of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024)


STAGES = [
    ("toxicity", clean), ("exact_dedup", distinct), ("simhash_near_dedup", dissimilar), ("mixing", mixed), ("packing", packed),
]

#: SQL has neither the classifier nor the tokenizer; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
