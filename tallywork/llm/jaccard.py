"""Documents of similar word shingles, by a blocked product of the incidence matrix with itself.

A row of the matrix is a document, a column a shingle; the product of the matrix with its transpose
counts the shingles that two documents share. Equal rows are multiplied once. The product is worked
out in two parts.

Dense blocks. Rows that agree in the least of their columns, in one of KEYS orders of all columns,
and are DENSE or more, are groups of copies, near and not so near. Such a group is multiplied
whole, in blocks of BLOCK rows by as many and of COLUMNS columns, and leaves a task as a forest of
the links found, not as pairs.

All other pairs. Only a row's prefix is multiplied: in one order of all columns (those that are
frequent last), the first n - ceil(t * n) + 1 of its n columns, as two rows with Jaccard similarity
t share one of these at least. This product is worked out in blocks of columns; each task adds up
the counts of its pairs, and a grouping adds up those of all tasks. A count over the prefixes is
complete up to the place where the shorter prefix ends (in the order of the columns), so the whole
overlap is at most the count plus the columns of that row behind its prefix. Pairs for which that
is less than the overlap their sizes call for are discarded; the others are counted over whole
rows. Pairs of a dense block or of one component are not counted again. Two rows that could not
link by the frequent columns of their prefixes alone are not counted in those, but taken to share
them. A column of more than MANY rows is cut into blocks of rows, each two of them in a task of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import text_of, written
from tallywork.llm.components import components

WORDS = 5
#: The similarity that links, as a percentage.
PERCENT = 80
#: A shingle in the matrix is 48 bits of its hash; two different ones of a pair of documents with
#: m and n shingles are the same there with a chance of m * n / 2**48.
BITS = 48
#: Documents, expected, on which the frequent columns are found. Which they are decides in what
#: order columns are taken and where a pair is counted, not what is found.
SAMPLE = 20_000
#: Columns in this many documents of the sample are frequent.
FREQUENT = 6
#: Orders in which the least column of a row names its groups, and rows from which a group is dense.
#: Both only decide where a pair is multiplied.
KEYS = 6
DENSE = 16
#: Rows and columns of a dense block.
BLOCK, COLUMNS = 1024, 4096
#: Rows of a column that a task multiplies with each other; beyond, it is cut into blocks.
MANY = 8192
#: Pairs that a task holds before it adds up their counts and passes them on.
PAIRS = 500_000
#: Bits of the map of rows that are needed whole: a fixed size, whatever the number of rows.
MAP_BITS = 1 << 24
PREFIX = ["column", "row", "n", "last", "often"]
PREFIX_TYPES = ", ".join(f"{name} long" for name in PREFIX)
PAIR = "a long, b long, na long, nb long, more long, shared long"


class Words(dict):
    """64-bit hashes by word, forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def multipliers(words: int) -> np.ndarray:
    """An odd number for each place in a shingle."""
    return np.array([xxhash.xxh64_intdigest(b"place %d" % i) | 1 for i in range(words)], np.uint64)


def shingles(text: str, known: Words, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of fewer words the one hash of all."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.array([], np.uint64)
    ids = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    k = min(words, len(ids))
    total = np.full(len(ids) - k + 1, k, np.uint64)
    for place, factor in enumerate(multipliers(k)):
        total += ids[place : len(ids) - k + 1 + place] * factor
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(32)))


def packed(columns: np.ndarray) -> bytes:
    """Sorted numbers below 2**48 as differences, lowest bytes first."""
    steps = np.diff(columns, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8)[:, : BITS // 8].T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    bytes_of = np.frombuffer(blob, np.uint8).reshape(BITS // 8, -1)
    steps = np.zeros((bytes_of.shape[1], 8), np.uint8)
    steps[:, : BITS // 8] = bytes_of.T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def least_of(columns: np.ndarray) -> list[int]:
    """The least column in each order, as that order's hash of it."""
    found = []
    for factor in multipliers(KEYS) * np.uint64(4) + np.uint64(1):
        mixed = columns * factor
        mixed ^= mixed >> np.uint64(31)
        found.append(int((mixed * np.uint64(0x94D049BB133111EB)).min().view(np.int64)))
    return found


def with_rows(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(doc_id, row, n, columns, keys): the row's 64-bit name and size, and where the task has not
    yet passed on a row of that name its columns and the least of them in each of KEYS orders."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kinds = [T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("columns", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(), set()
        for batch in batches:
            names, sizes, blobs, keys = [], [], [], []
            for value in batch.column(1):
                found = shingles(value.as_py(), known, words)
                name = xxhash.xxh64_intdigest(found.tobytes())
                names.append(name)
                sizes.append(len(found))
                columns = np.unique(found >> np.uint64(64 - BITS)) if len(found) and name not in seen else None
                blobs.append(None if columns is None else packed(columns))
                keys.append(None if columns is None else least_of(columns))
                seen.add(name)
            rows = pa.array(np.array(names, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), rows, pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "row", "n", "columns", "keys"],
            )

    return source.mapInArrow(computed, T.StructType([source.schema["doc_id"], *kinds]))


def frequent_columns(rows: DataFrame, sample: int, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns in ``frequent`` rows or more of a sample, sorted, and how often, as powers of two.

    At most sample * shingles a row / frequent of them. They only decide in which order the columns
    of a row are taken."""
    share = int(min(1.0, sample / max(1, rows.count())) * (1 << 40))
    drawn = rows.filter("columns is not null").filter(F.pmod(F.xxhash64("row", F.lit(7)), F.lit(1 << 40)) < share)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(blob.as_py()).view(np.int64))], names=["column"])

    counts = drawn.select("columns").mapInArrow(listed, "column long").groupBy("column").agg(F.count(F.lit(1)).alias("rows"))
    found = counts.filter(F.col("rows") >= frequent).orderBy("column").toPandas()
    return found["column"].to_numpy(np.uint64), np.minimum(np.log2(found["rows"].to_numpy(float) + 0.5).astype(np.uint64), 15)


def prefix(n, percent: int):
    """How many columns of a row of n are in its prefix."""
    return n + percent * n // -100 + 1


def entries(rows: DataFrame, common: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """(column, row, n, last, often): the prefix of each row, the last column in it and the number
    of its frequent ones."""
    names, classes = common

    def ordered(columns: np.ndarray) -> np.ndarray:
        if not len(names):
            return columns
        at = np.minimum(np.searchsorted(names, columns), len(names) - 1)
        often = np.where(names[at] == columns, classes[at] + np.uint64(1), np.uint64(0))
        return np.sort((often << np.uint64(BITS)) | columns)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sizes = [], []
            for blob, n in zip(batch.column(2), batch.column(1).to_numpy()):
                taken = ordered(unpacked(blob.as_py()))[: prefix(int(n), percent)]
                parts.append(taken)
                sizes.append(len(taken))
            if not parts:
                continue
            last = np.array([part[-1] for part in parts], np.uint64)
            often = np.array([len(part) - np.searchsorted(part, np.uint64(1 << BITS)) for part in parts])
            row, n = (np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1))
            made = [np.concatenate(parts).view(np.int64), row, n, np.repeat(last, sizes).view(np.int64), np.repeat(often, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=PREFIX)

    return rows.filter("columns is not null").select("row", "n", "columns").mapInArrow(spread, PREFIX_TYPES)


def added_up(pairs: list[np.ndarray]) -> pa.RecordBatch:
    """Equal pairs of (a, b, na, nb, more) once, with their number."""
    every = np.concatenate(pairs, axis=1) if pairs else np.zeros((5, 0), np.int64)
    order = np.lexsort((every[1], every[0]))
    every = every[:, order]
    new = np.ones(every.shape[1], bool)
    new[1:] = (every[:2, 1:] != every[:2, :-1]).any(axis=0)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, every.shape[1]))
    arrays = [pa.array(x) for x in every[:, starts]] + [pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "na", "nb", "more", "shared"])


def paired(i: np.ndarray, j: np.ndarray, column, row, n, last, often, percent: int) -> np.ndarray:
    """Pairs of the given places, smaller name first: names, sizes, and how much the rows can share
    besides what is counted, too. That is what the row whose prefix ends first has behind it (of
    two that end alike the fewer), and the frequent columns of both prefixes where they are too few
    to link the pair; such a pair is left out at frequent columns."""
    rest = n - prefix(n, percent)
    a, b = np.where(row[i] < row[j], i, j), np.where(row[i] < row[j], j, i)
    behind = np.where(last[a] < last[b], rest[a], np.where(last[b] < last[a], rest[b], np.minimum(rest[a], rest[b])))
    both = np.minimum(often[a], often[b])
    apart = both + behind < -(-percent * (n[a] + n[b]) // (100 + percent))
    keep = ~(apart & (column[i] >> BITS > 0))
    a, b, more = a[keep], b[keep], (behind + np.where(apart, both, 0))[keep]
    return np.stack([row[a], row[b], n[a], n[b], more])


def by_column(batches: Iterator[pa.RecordBatch], fields: int, cells: int) -> Iterator[np.ndarray]:
    """Rows of sorted batches, all rows of a cell (the first ``cells`` fields) in one array."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(fields)])
        new = np.flatnonzero((now[:cells, 1:] != now[:cells, :-1]).any(axis=0))
        edge = int(new[-1]) + 1 if len(new) else 0
        if held and (edge or (held[-1][:cells, -1] != now[:cells, 0]).any()) and size + edge >= 50_000:
            if not edge:
                yield np.concatenate(held, axis=1)
                held, size = [now], now.shape[1]
                continue
            yield np.concatenate([*held, now[:, :edge]], axis=1)
            held, size = [], 0
            now = now[:, edge:]
        held.append(now)
        size += now.shape[1]
    if held:
        yield np.concatenate(held, axis=1)


def crossed(percent: int):
    """Of every column the pairs of rows in different components, and in no dense block together,
    whose sizes can link. Rows come sorted by size; row i meets the rows behind it that are no
    longer than it allows."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        size = 0
        for column, cell, n, row, last, often, root, block, *dense in by_column(batches, 8 + KEYS, 2):
            new = np.ones(len(column), bool)
            new[1:] = (column[1:] != column[:-1]) | (cell[1:] != cell[:-1])
            group = np.cumsum(new) - 1
            # Sizes as one rising sequence over all cells, to search the end of each row's partners.
            width = int(n.max()) + 1
            reach = np.searchsorted(group * width + n, group * width + np.minimum(100 * n // percent, width - 1), side="right")
            many = reach - np.arange(len(column)) - 1
            low = 0
            while low < len(column):
                upto = np.cumsum(many[low:])
                high = low + max(1, int(np.searchsorted(upto, PAIRS, side="right")))
                i = np.repeat(np.arange(low, high), many[low:high])
                if len(i):
                    j = np.arange(len(i)) - np.repeat(upto[: high - low] - many[low:high], many[low:high]) + i + 1
                    # A cell of two blocks has the pairs across them only.
                    ours = (cell[i] == -1) | (np.minimum(block[i], block[j]) * (1 << 20) + np.maximum(block[i], block[j]) == cell[i])
                    keep = (root[i] != root[j]) & ours
                    for key in dense:
                        keep &= (key[i] != key[j]) | (key[i] == 0)
                    if keep.any():
                        found.append(paired(i[keep], j[keep], column, row, n, last, often, percent))
                        size += found[-1].shape[1]
                if size > PAIRS:
                    yield added_up(found)
                    found, size = [], 0
                low = high
        yield added_up(found)

    return linked


def counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(*[F.max(x).alias(x) for x in ("na", "nb", "more")], F.sum("shared").alias("shared"))


def asked(percent: int) -> Column:
    """The smallest overlap that links rows of sizes na and nb."""
    return F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / F.lit(100 + percent))


def needed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, columns) of the named rows, once each. A bit map of fixed size keeps most of the
    others from being shuffled; the join takes out the rest."""
    bit = F.pmod(F.xxhash64("row"), F.lit(MAP_BITS)) + 1
    maps = names.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map"))
    whole = np.zeros((MAP_BITS // 32768, 4096), np.uint8)
    for r in maps.collect():  # a row of 4 kB for each 32768 bits
        whole[r["part"] - 1] = np.frombuffer(r["map"], np.uint8)
    whole = whole.reshape(-1)
    marked = rows.filter("columns is not null").select("row", "columns", (bit - 1).alias("bit"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            keep = (whole[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(keep.astype(bool))).select(["row", "columns"])

    kept = marked.mapInArrow(held, "row long, columns binary").join(names, "row", "left_semi")
    return kept.groupBy("row").agg(F.first("columns").alias("columns"))


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared columns of each pair."""
    for batch in batches:
        shared = []
        held, left = None, None
        for x, y in zip(batch.column(4), batch.column(5)):
            if x != held:
                held, left = x, unpacked(x.as_py())
            right = unpacked(y.as_py())
            both = np.sort(np.concatenate([left, right]))
            shared.append(int((both[1:] == both[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(shared, pa.int64())], names=["a", "b", "na", "nb", "shared"])


def verified(rows: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """Pairs (a, b), a > b, whose whole rows link."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    whole = written(needed(rows, names), f"{name}-rows")
    left, right = (whole.select(F.col("row").alias(x), F.col("columns").alias(f"{x}_columns")) for x in ("a", "b"))
    joined = pairs.select("a", "b", "na", "nb").join(right, "b").join(left, "a").select("a", "b", "na", "nb", "a_columns", "b_columns")
    found = joined.mapInArrow(overlaps, "a long, b long, na long, nb long, shared long")
    links = found.filter(F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("shared")))
    return written(links.select(F.col("b").alias("a"), F.col("a").alias("b")), name)


def in_blocks(multi: DataFrame, block: int) -> DataFrame:
    """The rows of each column with their cell: -1, or one for each two blocks of a column that has
    more than ``block`` rows. A column is counted before it is cut."""
    counts = multi.groupBy("column").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > block)
    large = written(counts.select("column", F.ceil(F.col("rows") / block).cast("long").alias("blocks")), "large-columns")
    own = F.pmod(F.xxhash64("row"), F.col("blocks"))
    dealt = multi.join(large, "column", "left").withColumn("block", F.coalesce(own, F.lit(0).cast("long")))
    other = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("blocks"), F.lit(1).cast("long")) - 1)
    cell = F.transform(other, lambda x: F.least(x, F.col("block")) * (1 << 20) + F.greatest(x, F.col("block")))
    cells = F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(cell)
    return dealt.select("column", F.explode(cells).alias("cell"), "n", "row", "last", "often", "root", "block", *[f"k{i}" for i in range(KEYS)])


def memberships(rows: DataFrame, dense: int) -> DataFrame:
    """(row, n, i, key, members): the dense groups that a row is in; ``key`` is not zero."""
    once = rows.filter("columns is not null").groupBy("row", "n").agg(F.first("keys").alias("keys"))
    keyed = once.select("row", "n", F.posexplode("keys").alias("i", "least"))
    keyed = keyed.select("row", "n", "i", F.xxhash64("i", "least").bitwiseOR(F.lit(1)).alias("key"))
    groups = keyed.groupBy("i", "key").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") >= dense)
    return written(keyed.join(groups, ["i", "key"]), "dense-groups")


class Forest:
    """Disjoint sets of rows."""

    def __init__(self, size: int) -> None:
        self.up = list(range(size))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def link(self, a: int, b: int) -> None:
        p, q = self.find(a), self.find(b)
        if p != q:
            self.up[p] = q
            self.links.append((a, b))


def product(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many columns each row of ``left`` shares with each of ``right``."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    total = np.zeros((len(left), len(right)), np.float32)
    parts = []
    for columns, rows in ((a, left), (b, right)):
        row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        at = np.minimum(np.searchsorted(both, columns), max(0, len(both) - 1))
        held = both[at] == columns if len(both) else np.zeros(len(columns), bool)
        order = np.argsort(at[held], kind="stable")
        parts.append((row[held][order], at[held][order], len(rows)))
    for first in range(0, len(both), COLUMNS):
        blocks = []
        for row, at, size in parts:
            some = slice(*np.searchsorted(at, [first, first + COLUMNS]))
            block = np.zeros((size, min(COLUMNS, len(both) - first)), np.float32)
            block[row[some], at[some] - first] = 1
            blocks.append(block)
        total += blocks[0] @ blocks[1].T
    return total


def multiplied(percent: int):
    """The links of each dense block, as a forest. Rows come sorted by group and cell."""

    def linked(names: list[int], sizes: list[int], blocks: list[int], columns: list[bytes]) -> pa.RecordBatch:
        sets, n, side = [unpacked(c) for c in columns], np.array(sizes), np.array(blocks)
        forest = Forest(len(names))
        which = np.unique(side)
        first, second = np.flatnonzero(side == which[0]), np.flatnonzero(side == which[-1])
        for low in range(0, len(first), BLOCK):
            for high in range(low if len(which) == 1 else 0, len(second), BLOCK):
                i, j = first[low : low + BLOCK], second[high : high + BLOCK]
                shared = product([sets[x] for x in i], [sets[x] for x in j])
                linked = 100 * shared >= percent * (n[i][:, None] + n[j][None, :] - shared)
                for x, y in zip(*np.nonzero(linked)):
                    if i[x] != j[y]:
                        forest.link(int(i[x]), int(j[y]))
        pairs = [(max(names[a], names[b]), min(names[a], names[b])) for a, b in forest.links]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for key, cell, row, n, block, columns in zip(*[batch.column(i) for i in range(6)]):
                at = (key.as_py(), cell.as_py())
                if at != now and held:
                    yield linked(*map(list, zip(*held)))
                    held = []
                now = at
                held.append((row.as_py(), n.as_py(), block.as_py(), columns.as_py()))
        if held:
            yield linked(*map(list, zip(*held)))

    return links


def dense_links(rows: DataFrame, groups: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b), a > b: forests of the links in each dense group."""
    blocks = F.ceil(F.col("members") / block).cast("long")
    own = F.pmod(F.xxhash64("row", "key"), blocks).alias("block")
    other = F.sequence(F.lit(0).cast("long"), blocks - 1)
    dealt = groups.select("row", "n", "key", own, other.alias("others"))
    cell = F.explode(F.transform("others", lambda x: F.least(x, F.col("block")) * (1 << 31) + F.greatest(x, F.col("block")))).alias("cell")
    dealt = dealt.select("row", "n", "key", "block", cell)
    whole = needed(rows, groups.select("row").distinct())
    joined = dealt.join(whole, "row").select("key", "cell", "row", "n", "block", "columns")
    sent = joined.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return written(sent.mapInArrow(multiplied(percent), "a long, b long"), "dense-links")


def join_similar(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    sample: int = SAMPLE,
    frequent: int = FREQUENT,
    dense: int = DENSE,
    block: int = BLOCK,
    many: int = MANY,
) -> DataFrame:
    """A row per document: doc_id, n_shingles (distinct), component_id.

    A shingle is ``words`` words in a row, A-Z in lower case; a text of fewer words is one shingle.
    Documents link when they share ``percent`` per cent of the shingles that either has;
    component_id is the smallest id that links reach, itself included. Null, empty and blank texts
    have no shingle and link with nothing, not even each other: their component is their own id.
    Equal sets always link. A null id counts as largest and is a component's id only if no member
    has another. Rows that repeat come back as often. Other columns of ``docs`` are not read; an
    empty table gives no rows. ``sample`` to ``many`` say how the work is dealt out and change no
    row."""
    rows = written(with_rows(docs, doc_id, text, words), "incidence")
    groups = memberships(rows, dense)
    first = components(dense_links(rows, groups, percent, block))

    common = frequent_columns(rows, sample, frequent)
    dealt = entries(rows, common, percent).repartition("column").sortWithinPartitions("column", "n", "row")
    prefixes = written(dealt.mapInArrow(shared_only, PREFIX_TYPES), "prefixes")
    nothing = F.lit(0).cast("long")
    keys = groups.groupBy("row").agg(*[F.max(F.when(F.col("i") == i, F.col("key"))).alias(f"k{i}") for i in range(KEYS)])
    known = first.select(F.col("a").alias("row"), F.col("b").alias("known"))
    said = written(keys.join(known, "row", "full"), "dense-rows")
    multi = prefixes.join(said, "row", "left")
    multi = multi.select(*PREFIX, F.coalesce("known", "row").alias("root"), *[F.coalesce(f"k{i}", nothing).alias(f"k{i}") for i in range(KEYS)])
    cells = in_blocks(multi, many).repartition("column", "cell").sortWithinPartitions("column", "cell", "n", "row")
    across = counted(cells.mapInArrow(crossed(percent), PAIR)).filter(F.col("shared") + F.col("more") >= asked(percent))
    second = verified(rows, written(across, "pairs"), percent, "pair-links")

    names = rows.filter("n > 0").groupBy("row").agg(F.min("doc_id").alias("least"))
    known = names.join(first, names["row"] == first["a"], "left").select("row", "least", F.coalesce("b", "row").alias("root"))
    known = written(known, "roots")
    roots = known.select("row", "root")
    merged = second.join(roots.select(F.col("row").alias("a"), F.col("root").alias("p")), "a").join(roots.select(F.col("row").alias("b"), F.col("root").alias("q")), "b")
    merged = merged.filter("p != q").select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct()
    last = components(merged)
    known = known.join(last, known["root"] == last["a"], "left").select("row", "least", F.coalesce("b", "root").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = known.join(least, "root").select(F.col("row").alias("name"), "component_id")
    joined = rows.join(ids, (rows["row"] == ids["name"]) & (rows["n"] > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each once, of columns that more than one row has."""
    for every in by_column(batches, len(PREFIX), 1):
        new = np.ones(every.shape[1], bool)
        new[1:] = (every[:2, 1:] != every[:2, :-1]).any(axis=0)
        every = every[:, new]
        column = every[0]
        same = np.zeros(len(column) + 1, bool)
        same[1:-1] = column[1:] == column[:-1]
        keep = same[1:] | same[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in every], names=PREFIX)
