"""Token ids in ORC files: written in the order of document ids, read back stripe by stripe.

Spark's ORC writer run-length encodes the integers, and keeps row indexes and a Bloom filter on
the document id per row group, so a reader skips stripes by metadata."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import text_of
from tallywork.llm.tokens import encoder

OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
BATCH_IDS = 2_000_000


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes (doc_id, copy, ids) in ascending order of doc_id, nulls first, files in that order.

    Null and empty texts have the end id alone. Rows that repeat an id stand together in one file,
    shorter texts first, and are numbered from 0 (``copy``); all of them are written. Texts, not ids, are shuffled: they take less room."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("copy", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False).encode
        last, copy = None, 0

        def numbered(ids: list) -> pa.Array:
            nonlocal last, copy
            out = []
            for doc in ids:
                copy = copy + 1 if (doc,) == last else 0
                last = (doc,)
                out.append(copy)
            return pa.array(out, pa.int64())

        def out(column: pa.Array, first: int, held: list[bytes]) -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(raw) // 4 for raw in held], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(held), "<i4")))
            own = column.slice(first, len(held))
            return pa.RecordBatch.from_arrays([own, numbered(own.to_pylist()), ids], names=schema.names)

        for batch in batches:
            first, size, held = 0, 0, []
            for raw in encode(map(str, batch.column(1))):
                held.append(raw + end)
                size += len(raw) // 4 + 1
                if size > BATCH_IDS:
                    yield out(batch.column(0), first, held)
                    first, size, held = first + len(held), 0, []
            if held:
                yield out(batch.column(0), first, held)

    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.length("text"), F.xxhash64("text"))
    ordered.mapInArrow(encoded, schema).write.options(**OPTIONS).orc(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document of such files: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it, over all files. Running sums go over one
    file at a time; files add up in the order of their ids, not of their names, which takes one row
    per file. Rows that share an id follow each other as they do in the file."""
    stored = spark.read.orc(folder)
    source = stored.select("doc_id", "copy", "ids", F.col("_metadata.file_name").alias("file"))
    schema = T.StructType(
        [stored.schema["doc_id"], T.StructField("copy", T.LongType()), T.StructField("file", T.StringType()),
         T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            raw = memoryview(ids.values.to_numpy(zero_copy_only=True).astype("<u4", copy=False)).cast("B")
            edges = ids.offsets.to_numpy()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            counts = pa.array(np.diff(edges).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), counts, pa.array(crc, pa.int64())], names=schema.names)

    rows = source.mapInArrow(summed, schema)
    inside = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "copy")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    # the totals come from the files' row counts of ids, read once more by column
    files = stored.select(F.col("_metadata.file_name").alias("at_file"), "doc_id", F.size("ids").alias("n")).groupBy("at_file")
    files = files.agg(F.sum("n").alias("n"), F.bool_or(F.col("doc_id").isNull()).alias("has_null"), F.min("doc_id").alias("least"))
    before = Window.orderBy(F.col("has_null").desc(), "least").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("at_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(files, placed["file"] == files["at_file"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )
