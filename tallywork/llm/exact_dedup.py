"""Exact deduplication by a Grace hash: complete contents are compared.

Spark deals the texts out by hash. Each task fills an open-addressing table that compares whole
texts; when the distinct texts outgrow it, table and further records are partitioned by fresh
hash bits into spill files, and each file is treated likewise. Before the shuffle the same table
merges the copies of one task, so a group of any size costs a row per task. A spill bucket of
equal texts needs no split: the table holds one of them."""

from __future__ import annotations

import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import single_spaced, text_of, without, written

#: Bytes of distinct texts that one table holds.
TABLE_BYTES = 64_000_000
FAN_OUT = 16
MOST_LEVELS = 12
RESULT = ("keep_id", "group_size", "kept", "text_sha256")
BATCH_BYTES = 8_000_000

#: digest, hash, content, number of rows, smallest id (None: all null)
Record = tuple[str, int, bytes, int, int | None]
HEAD = struct.Struct("<64sqqqBq")


class ContentTable:
    """Open addressing with linear probing, keyed by the complete content."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.rows: list[list] = []
        self.bytes = 0

    def add(self, record: Record) -> None:
        digest, hashed, content, count, least = record
        mask = len(self.slots) - 1
        at = hashed & mask
        while (row := self.slots[at]) >= 0:
            found = self.rows[row]
            if found[1] == hashed and found[2] == content:
                found[3] += count
                if least is not None and (found[4] is None or least < found[4]):
                    found[4] = least
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.rows.append([digest, hashed, content, count, least])
        self.bytes += len(content) + 300
        if 2 * len(self.rows) > len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            mask = len(self.slots) - 1
            for row, found in enumerate(self.rows):
                at = found[1] & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = row


def put(file, record: Record) -> None:
    digest, hashed, content, count, least = record
    file.write(HEAD.pack(digest.encode(), hashed, len(content), count, least is not None, least or 0))
    file.write(content)


def take(file) -> Iterator[Record]:
    file.seek(0)
    while head := file.read(HEAD.size):
        digest, hashed, size, count, has, least = HEAD.unpack(head)
        yield digest.decode(), hashed, file.read(size), count, least if has else None


def groups(records: Iterator[Record], table_bytes: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """A record per distinct content. Spill files are unnamed and go with the task."""
    content = ContentTable()
    for record in records:
        content.add(record)
        if content.bytes > table_bytes and len(content.rows) > 1 and level < MOST_LEVELS:
            break
    else:
        yield from map(tuple, content.rows)
        return
    files = [tempfile.TemporaryFile(buffering=1 << 16) for _ in range(FAN_OUT)]
    bucket = lambda hashed: files[(hashed >> (4 * level + 10)) % FAN_OUT]
    for row in content.rows:
        put(bucket(row[1]), tuple(row))
    del content
    for record in records:
        put(bucket(record[1]), record)
    for file in files:
        yield from groups(take(file), table_bytes, level + 1)
        file.close()


def combined(records: Iterator[Record], table_bytes: int) -> Iterator[Record]:
    """Merges what it can hold and passes it on whenever the table is full."""
    content = ContentTable()
    for record in records:
        content.add(record)
        if content.bytes > table_bytes:
            yield from map(tuple, content.rows)
            content = ContentTable()
    yield from map(tuple, content.rows)


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        digest, hashed, content, count, least = batch.columns
        for i in range(batch.num_rows):
            yield digest[i].as_py(), hashed[i].as_py(), content[i].as_py(), count[i].as_py(), least[i].as_py()


SCHEMA = "digest string, hashed long, content binary, count long, least long"
ARROW = pa.schema([("digest", pa.string()), ("hashed", pa.int64()), ("content", pa.binary()), ("count", pa.int64()), ("least", pa.int64())])


def batched(found: Iterator[Record], columns: list[int]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([ARROW.field(c) for c in columns])
    held: list[Record] = []
    size = 0
    for record in found:
        held.append(record)
        size += len(record[2]) + 100
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], ARROW.field(c).type) for c in columns], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], ARROW.field(c).type) for c in columns], schema=schema)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when they are identical once every run of white space is a single space; null
    counts as empty. keep_id is the smallest id (an integer) of the equal texts, null ids last;
    rows that repeat an id and its text count each and are all marked as kept. Columns of ``docs``
    named like a result are replaced; an empty table gives no rows.

    The groups are found by complete content. Each row then finds its group by three numbers of
    its content (SHA-256, a second hash, the length); should two contents ever agree in all three,
    the job stops with an error rather than merge them. That join has all rows of a group under
    one key, but only one row on the other side, so adaptive execution can split it."""
    if {doc_id.lower(), text.lower()} & {name.lower() for name in RESULT}:
        raise ValueError("the columns of id and text must not be named like a result")
    spaced = single_spaced(text_of(text))
    digests = {"text_sha256": F.sha2(spaced.cast("binary"), 256), "__hashed": F.xxhash64(spaced), "__length": F.length(spaced)}
    source = docs.select(
        digests["text_sha256"].alias("digest"), digests["__hashed"].alias("hashed"), spaced.cast("binary").alias("content"),
        F.lit(1).cast("long").alias("count"), F.col(doc_id).cast("long").alias("least"),
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(combined(records(batches), table_bytes), [0, 1, 2, 3, 4])

    def deduplicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_groups() -> Iterator[Record]:
            yield from groups(records(batches), table_bytes)

        for batch in batched(all_groups(), [0, 1, 2, 3, 4]):
            lengths = pa.array([len(x.as_py().decode()) for x in batch.column(2)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lengths, batch.column(3), batch.column(4)],
                names=["digest", "hashed", "length", "count", "least"],
            )

    merged = source.mapInArrow(merge, SCHEMA).repartition("hashed")
    found = merged.mapInArrow(deduplicate, "digest string, hashed long, length int, count long, least long")
    one = found.groupBy("digest", "hashed", "length").agg(
        F.max("count").alias("group_size"), F.min("least").alias("keep_id"), F.count("*").alias("__contents")
    )
    safe = F.when(F.col("__contents") == 1, F.col("keep_id")).otherwise(F.raise_error(F.lit("two texts agree in every digest")))
    one = one.select(
        F.col("digest").alias("__digest"), F.col("hashed").alias("__same_hash"), F.col("length").alias("__same_length"),
        "group_size", safe.cast("long").alias("keep_id"),
    )
    rows = without(docs, *RESULT).withColumns(digests)
    same = (
        (rows["text_sha256"] == one["__digest"]) & (rows["__hashed"] == one["__same_hash"]) & (rows["__length"] == one["__same_length"])
    )
    return (
        rows.join(one, same)
        .drop("__digest", "__same_hash", "__same_length", "__hashed", "__length")
        .withColumn("keep_id", F.col("keep_id").cast(docs.schema[doc_id].dataType))
        .withColumn("kept", F.col(doc_id).eqNullSafe(F.col("keep_id")))
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, all columns: that of the smallest id, null ids last; of
    rows that share it one, chosen by a hash of all columns. An empty table gives no rows.

    A group of one row, and most are, is passed on as it is."""
    found = exact_groups(docs, doc_id, text).filter("kept").select(*docs.columns, "group_size", "text_sha256")
    found = written(found, "kept")
    several = found.filter("group_size > 1").groupBy("text_sha256")
    picked = several.agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    return found.filter("group_size = 1").select(*docs.columns).unionByName(picked.select("row.*"))
