"""Packing of token ids into windows of one length: best-fit decreasing.

Documents are tokenised where they are read; only their pieces (a few numbers each) are
shuffled. A document longer than a window is first cut into full windows. What is left of
each document goes, largest first, into the open window with the least room that still takes
it; a segment tree over the remaining capacities finds that window. Each partition of pieces
packs on its own, so it leaves one badly filled window or so, however many pieces it has."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import text_of
from tallywork.llm.tokens import encoder


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose nodes say whether a window
    with a capacity of their range is open."""

    def __init__(self, width: int):
        self.base = 1 << width.bit_length()
        self.any = [0] * (2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, window: int, room: int) -> None:
        if not self.at[room]:
            i = self.base + room
            while i and not self.any[i]:
                self.any[i] = 1
                i >>= 1
        self.at[room].append(window)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes the tightest open window with room for ``size``: (window, its room)."""
        i = self.base + size
        if not self.any[i]:
            while i > 1 and (i & 1 or not self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.base
        window = self.at[room].pop()
        if not self.at[room]:
            self.any[i] = 0
            i >>= 1
            while i and not (self.any[2 * i] or self.any[2 * i + 1]):
                self.any[i] = 0
                i >>= 1
        return window, room


def best_fit(lengths: list[int], width: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; ``lengths`` falls and each is at most ``width``."""
    open_windows, windows, offsets, used = OpenWindows(width), [], [], 0
    for length in lengths:
        found = open_windows.take(length) if length < width else None
        if found is None:
            window, room = used, width
            used += 1
        else:
            window, room = found
        windows.append(window)
        offsets.append(width - room)
        if room > length:
            open_windows.put(window, room - length)
    return windows, offsets


def cut(docs: DataFrame, tokenizer: str, width: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Pieces of at most ``width`` ids, one row each, with the checksum of their ids."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    schema = T.StructType(
        [source.schema["doc_id"]] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    )
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        for batch in batches:
            rows, start, length, crc, total = [], [], [], [], []
            for row, ids in enumerate(encode(map(str, batch.column(1)))):
                raw = memoryview(ids + end)
                n = len(raw) // 4
                for a in range(0, n, width):
                    part = raw[4 * a : 4 * (a + width)]
                    rows.append(row)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(x, pa.int64()) for x in (start, length, crc, total)], names=schema.names
            )

    return source.mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, tokenizer: str, width: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizer file, the same on every executor. Null
    and empty texts have the end id alone. Rows that repeat, or that share an id, are packed
    each; equal lengths are taken in the order of id and start, nulls last. An empty table gives
    no rows. Other columns of ``docs`` are not read. Sequence numbers are unique but have gaps:
    the partition is in their upper bits."""
    cut_pieces = cut(docs, tokenizer, width, end_id, doc_id, text)
    schema = T.StructType(cut_pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        pieces = pa.Table.from_batches(held)
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        pieces = pieces.sort_by(order).combine_chunks()
        windows, offsets = best_fit(pieces["length"].to_pylist(), width)
        first = TaskContext.get().partitionId() << 32
        pieces = pieces.append_column("sequence_id", pa.array(np.array(windows, np.int64) + first))
        yield from pieces.append_column("offset", pa.array(offsets, pa.int64())).to_batches(max_chunksize=10_000)

    return cut_pieces.repartition(F.xxhash64("doc_id", "start")).mapInArrow(packed, schema)
