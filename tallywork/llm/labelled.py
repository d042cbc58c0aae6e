"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import text_of, written


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def usable(labels: DataFrame, label: str, keep: Column, doc_id: str = "doc_id") -> DataFrame:
    """(__id, label) of labelled ids with ``keep``. Null labels and ids don't count; where labels of
    one id differ the largest holds."""
    known = labels.filter(keep & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return known.groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("label"))


def weights(labels: DataFrame, label: str, keep: Column, most: dict[int, int], doc_id: str = "doc_id") -> dict[int, float]:
    """How many usable labels a sampled one of its class stands for in ``sample``."""
    found = {r["label"]: r["count"] for r in usable(labels, label, keep, doc_id).filter(F.col("label").isin(list(most))).groupBy("label").count().collect()}
    return {y: max(1.0, found.get(y, 0) / n) for y, n in most.items()}


def sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: dict[int, int], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(text, label) of labelled documents with ``keep``, at most ``most[y]`` of label y.

    Which ones is decided by a hash of the id. Null labels don't count; where labels of one id
    differ the largest holds. The sampled ids, a bounded number, are sent to the documents."""
    known = usable(labels, label, keep, doc_id)
    chosen = None
    for y, n in most.items():
        part = known.filter(F.col("label") == y).orderBy(F.xxhash64("__id"), "__id").limit(n)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(written(chosen, "sampled-ids"))
    rows = docs.select(F.col(doc_id).alias("__id"), text_of(text).alias("text")).join(chosen, "__id")
    return written(rows.select("text", "label"), "sampled-texts")
