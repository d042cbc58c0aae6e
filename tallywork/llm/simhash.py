"""Near-duplicates by SimHash, found by a range join on segment popcounts.

A fingerprint of 64 bits is cut into 32 segments of two bits. Its embedding is the vector of
their bit counts, kept in unary code: a segment is 00, 01 or 11. The Manhattan distance of two
vectors is then the number of differing bits of two words, and never above the Hamming distance
of the fingerprints. The 32 coordinates form seven groups. Vectors at a distance of 4 or less
agree in at least three groups, so the grid has a cell for each value of each three groups
(35 tables), and each fingerprint lies in 35 cells. Very many fingerprints are cut into more groups,
so that cells, by more coordinates each, stay as small. Within a cell, pairs pass the Manhattan bound
first and the exact Hamming distance last.

A cell never emits all its pairs: small cells are compared as sorted arrays, large ones by a
search that takes points out as they are reached, and each task passes on a spanning forest."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import text_of, written
from tallywork.llm.components import components

DISTANCE = 4
SHINGLE = 4
SEED = 42
#: Least number of groups; chance cells have at most so many fingerprints of those counted.
GROUPS, CHANCE_ROWS = 7, 256
RESULT = ("fingerprint", "component_id")
#: Cells up to this size are compared by shifting the sorted array.
SHIFTS = 8
#: Rows of the grid that a task links before it passes on a forest.
FOREST_ROWS = 2_000_000
LOW_BITS = 0x5555555555555555


def fingerprint(text: str) -> int:
    """The bits that are set in over half of the hashes of all shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0] + [end + 1 for end in ends]
    digest = xxhash.xxh64_intdigest
    pieces = zip(starts, ends[min(SHINGLE, len(words)) - 1 :])
    counts, total = np.zeros(64, np.int64), 0
    hashes = [digest(joined[a:b], SEED) for a, b in pieces]
    for first in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[first : first + (1 << 16)], "<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(some)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp, content): fingerprints as signed longs, and a hash of the text."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), content_of(text).alias("content"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType()), T.StructField("content", T.LongType())])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], names=schema.names)

    return source.mapInArrow(computed, schema)


def content_of(text: str) -> Column:
    return F.xxhash64(text_of(text))


def embedding(fp: Column) -> Column:
    """Bit counts of the two-bit segments in unary code."""
    low = F.lit(LOW_BITS).cast("long")
    x, y = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return x.bitwiseOR(y).bitwiseOR(F.shiftleft(x.bitwiseAND(y), 1))


def groups_for(count: int) -> int:
    """Groups for so many different fingerprints: a segment's bit count tells 1.5 bits."""
    return next(g for g in range(GROUPS, 33) if g == 32 or count / 2 ** (48 * (g - DISTANCE) / g) <= CHANCE_ROWS)


def masks(number: int = GROUPS) -> list[int]:
    """Of all groups of coordinates but four, in each choice, the bits in the embedding."""
    groups = [0] * number
    for segment in range(32):
        groups[segment % number] |= 3 << (2 * segment)
    sums = [reduce(or_, some) for some in combinations(groups, number - DISTANCE)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def grid(fps: DataFrame, groups: int = GROUPS) -> DataFrame:
    """A row per fingerprint and table: table, cell, fp, vec."""
    vec = embedding(F.col("fp"))
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(masks(groups))])
    spread = fps.select("fp", vec.alias("vec")).select("fp", "vec", F.explode(tables).alias("t"))
    return spread.select("t.table", F.col("vec").bitwiseAND(F.col("t.mask")).alias("cell"), "fp", "vec")


def near(fp_a, fp_b, vec_a, vec_b) -> np.ndarray:
    """Manhattan distance as a lower bound, then the exact one."""
    close = np.bitwise_count((vec_a ^ vec_b).view(np.uint64)) <= DISTANCE
    close[close] = np.bitwise_count((fp_a ^ fp_b)[close].view(np.uint64)) <= DISTANCE
    return close


def links_of_small(key: np.ndarray, fp: np.ndarray, vec: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links between rows of one cell that are at most SHIFTS apart; ``key`` is sorted."""
    for shift in range(1, SHIFTS + 1):
        a = np.flatnonzero(key[shift:] == key[:-shift]) if len(key) > shift else np.array([], int)
        if not len(a):
            return
        close = near(fp[a], fp[a + shift], vec[a], vec[a + shift])
        yield fp[a[close]], fp[a[close] + shift]


def links_of_large(fp: np.ndarray, vec: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect a cell: points leave the array as soon as a search reaches them."""
    while len(fp):
        frontier = [(fp[0], vec[0])]
        fp, vec = fp[1:], vec[1:]
        while frontier and len(fp):
            at, at_vec = frontier.pop()
            close = near(fp, np.full_like(fp, at), vec, np.full_like(vec, at_vec))
            if close.any():
                yield fp[close], np.full(int(close.sum()), at)
                frontier.extend(zip(fp[close], vec[close]))
                fp, vec = fp[~close], vec[~close]


class Forest:
    """Disjoint sets; the least member is the root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent, top = self.parent, x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)

    def edges(self) -> pa.RecordBatch:
        pairs = [(x, self.root(x)) for x in list(self.parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition whose rows are sorted by table and cell."""
    forest, rows = Forest(), 0
    held: list[np.ndarray] = []

    def columns(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])

    def link(table, cell, fp, vec) -> None:
        new = np.flatnonzero((table[1:] != table[:-1]) | (cell[1:] != cell[:-1])) + 1
        sizes = np.diff(np.concatenate([[0], new, [len(table)]]))
        starts = np.concatenate([[0], new])
        key = np.repeat(np.arange(len(sizes)), sizes)
        small = np.repeat(sizes <= SHIFTS + 1, sizes)
        for a, b in links_of_small(key[small], fp[small], vec[small]):
            forest.link(a, b)
        for which in np.flatnonzero(sizes > SHIFTS + 1):
            part = slice(starts[which], starts[which] + sizes[which])
            for a, b in links_of_large(fp[part], vec[part]):
                forest.link(a, b)

    for batch in batches:
        if not batch.num_rows:
            continue
        now = columns(batch)
        last = np.flatnonzero((now[0] != now[0, -1]) | (now[1] != now[1, -1]))
        edge = int(last[-1]) + 1 if len(last) else 0
        if held and (edge or tuple(held[-1][:2, -1]) != tuple(now[:2, 0])):
            link(*np.concatenate([*held, now[:, :edge]], axis=1))
            rows += sum(x.shape[1] for x in held) + edge
            held = []
        elif edge:
            link(*now[:, :edge])
            rows += edge
        held.append(now[:, edge:])
        if rows > FOREST_ROWS:
            yield forest.edges()
            forest, rows = Forest(), 0
    if held:
        link(*np.concatenate(held, axis=1))
    yield forest.edges()


def linked_kinds(kinds: DataFrame) -> DataFrame:
    """(fp, least, root) from distinct fingerprints (fp, least): the smallest fingerprint that links reach."""
    kinds = written(kinds, "kinds")
    cells = grid(kinds.select("fp"), groups_for(kinds.count())).repartition("table", "cell").sortWithinPartitions("table", "cell", "fp")
    roots = components(cells.mapInArrow(linked, "a long, b long"))
    return kinds.join(roots, kinds["fp"] == roots["a"], "left").select("fp", "least", F.coalesce("b", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id.

    Two documents are linked when their fingerprints differ in 4 bits or fewer; component_id is
    the smallest id that links reach. Texts of fewer than four words are one shingle; null and
    empty texts have fingerprint zero and link like others. Null ids count as largest. Rows that
    repeat come back as often. Other columns of ``docs`` are not read; an empty table gives no
    rows.

    The fingerprints, 24 bytes a document, are written to the shared folder, as they are needed
    three times. The grid holds distinct fingerprints, so copies cost nothing there."""
    prints = written(with_fingerprints(docs, doc_id, text), "fingerprints")
    kinds = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    kinds = linked_kinds(kinds)
    least = kinds.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = kinds.join(least, "root").select(F.col("fp").alias("kind"), "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(ids, prints["fp"] == ids["kind"]).select("doc_id", shown, "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns: that of the smallest id, null ids last; of rows with
    one id the one of the smallest hash of its text, and of rows that repeat both any one, chosen by
    a hash of all columns. An empty table gives no rows.

    Only what goes is joined to the documents; rows that stay are not moved."""
    prints = written(with_fingerprints(docs, doc_id, text), "fingerprints")
    kinds = linked_kinds(prints.groupBy("fp").agg(F.min("doc_id").alias("least"))).select(F.col("fp").alias("kind"), "root")
    rows = prints.join(kinds, prints["fp"] == kinds["kind"]).groupBy("root", "doc_id", "content").agg(F.count(F.lit(1)).alias("rows"))
    rows = written(rows, "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("first")
    least = rows.groupBy("root").agg(first, F.count(F.lit(1)).alias("members")).filter("members > 1").drop("members")
    others = rows.join(least, "root").filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("content") == F.col("first.content"))))
    marked = docs.withColumns({"__id": F.col(doc_id), "__content": content_of(text)})

    def at(found: DataFrame) -> Column:
        return marked["__id"].eqNullSafe(found["__other"]) & (marked["__content"] == found["__text"])

    def named(found: DataFrame) -> DataFrame:
        return found.select(F.col("doc_id").alias("__other"), F.col("content").alias("__text"))

    gone, repeated = written(named(others), "gone"), written(named(rows.filter("rows > 1")).distinct(), "repeated")
    marked = marked.join(gone, at(gone), "left_anti")
    once = marked.join(repeated, at(repeated), "left_anti").select(*docs.columns)
    again = marked.join(repeated, at(repeated), "left_semi")
    picked = again.groupBy("__id", "__content").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    return once.unionByName(picked.select("row.*"))
