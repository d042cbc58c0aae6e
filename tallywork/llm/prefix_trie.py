"""The prefix trie of conversations, by union-find over the neighbours of their sorted sequences.

A conversation is a sequence of turns, a turn here 16 bytes: the MD5 of its role and text. Equal
sequences are one. Sequences are sorted over all partitions; two neighbours share as many turns as
the longest common prefix (LCP) of both. Each partition links its neighbours in descending order
of LCP with union-find: a component is a subtree, and where two meet at a depth there is a
branching node. What lies between a component's top and the depth where it meets another is a path
of nodes with the same members.

A node is complete in its partition unless the first sequence shares it with the partition before
or the last one with the partition after. Those nodes, at most two paths a partition, leave it with
what their closed subtrees add up to. Equal ones are merged over all partitions and the contracted
tree they form is added up from its deepest nodes; the nodes that hang on it get their parent from
it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import written

TURN = 16
#: Ids in a packed row.
PACK = 100_000
NOTHING = hashlib.sha256(b"").hexdigest()
#: Sequences that one task sorts into its forest.
PART = 50_000
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NAMES = ["key", "parent_key", "open", "own", "conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
KINDS = [pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 8, pa.string()]
MADE = "key binary, parent_key binary, open boolean, own long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
CONTRACTED = ["key", "parent_key", "conv_id", "depth", *SUMS, "ends_sha256"]
TOTALS = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns(talk: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of turn, code and bytes.

    Turns of one number (or none) come in the order of their codes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    numbered = F.col("turn").isNotNull().alias("numbered")
    turn = F.struct(numbered, F.col("turn"), code.alias("code"), F.octet_length(text).cast("long").alias("bytes"))
    known = talk.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return known.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(talk: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns): conversation c begins with the first h turns of conversation c - c % every,
    and goes on with its own after its first h; h is the checksum of c modulo ``heads``."""
    now = written(turns(talk), "turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    first = now.select(F.col("conv_id").alias("base"), F.col("turns").alias("head"))
    joined = now.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(first, "base", "left")
    none = F.array().cast(now.schema["turns"].dataType)
    head = F.when(h > 0, F.slice(F.coalesce("head", none), F.lit(1), h)).otherwise(none)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def sequences(talks: DataFrame) -> DataFrame:
    """(conv_id, seq, bytes): the turns' codes in one binary, and the bytes of their texts."""
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), "")).alias("seq")
    return talks.select("conv_id", seq, F.transform("turns", lambda t: t["bytes"]).alias("bytes"))


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one sequence, sorted by id, as one row of up to PACK ids."""
    seq, sizes, ids = None, None, []

    def made() -> pa.RecordBatch:
        arrays = [pa.array([seq], pa.binary()), pa.array([sizes], pa.list_(pa.int64())), pa.array([ids[0]], pa.int64()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["seq", "bytes", "first", "ids"])

    for batch in batches:
        for conv, now, lengths in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            now = now.as_py()
            if ids and (now != seq or len(ids) >= PACK):
                yield made()
                ids = []
            if not ids:
                seq, sizes = now, lengths.as_py()
            ids.append(conv)
    if ids:
        yield made()


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two sequences share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    low, high = 0, n // TURN  # the longest shared prefix, halving
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle
    return low


def key_of(seq: bytes, depth: int) -> bytes:
    """A node's name: the hash of its turns, which differ in number at different depths."""
    return hashlib.blake2b(seq[: depth * TURN], digest_size=16).digest()


class Leaf:
    """One sequence of a partition and its conversations."""

    __slots__ = ("seq", "sizes", "n", "least", "sha")

    def __init__(self, seq: bytes, sizes: list[int]) -> None:
        self.seq, self.sizes, self.n, self.least, self.sha = seq, sizes, 0, None, hashlib.sha256()

    def add(self, ids: np.ndarray) -> None:
        if self.n:
            self.sha.update(b",")
        else:
            self.least = int(ids[0])
        self.sha.update(",".join(map(str, ids.tolist())).encode())
        self.n += len(ids)


class Forest:
    """Subtrees of a partition's sorted sequences, joined from the deepest LCP upwards.

    ``before`` and ``after`` are how many turns the first and last sequence share with those of the
    partitions on either side. A component is named by its first leaf; its top is a node that is
    not yet passed on, as its members may still grow."""

    def __init__(self, leaves: list[Leaf], before: int, after: int) -> None:
        self.leaves, self.before, self.after = leaves, before, after
        m = len(leaves)
        self.up = list(range(m))
        self.end = list(range(m))  # last leaf of the component
        self.top = [len(x.seq) // TURN for x in leaves]
        self.n = [x.n for x in leaves]
        self.least = [x.least for x in leaves]
        self.sha: list[str | None] = [x.sha.hexdigest() for x in leaves]  # of those that end at the top
        # Of the top: its children, and of those that are complete here number, leaves and savings.
        self.children, self.closed, self.below, self.saved = [0] * m, [0] * m, [0] * m, [0] * m
        self.waiting: list[list[int]] = [[] for _ in range(m)]  # rows of children whose parent the top is
        self.rows: list[list] = []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def passed(self, c: int) -> None:
        """Pass on the top of component c, which is then the node above it."""
        leaf, d, n, least = self.leaves[c], self.top[c], self.n[c], self.least[c]
        is_open = d == 0 or (c == 0 and d <= self.before) or (self.end[c] == len(self.leaves) - 1 and d <= self.after)
        own = leaf.sizes[d - 1] if d else 0
        key = key_of(leaf.seq, d) if is_open else None
        for row in self.waiting[c]:
            self.rows[row][1], self.rows[row][6] = key, None if is_open else least
        self.waiting[c] = []
        if is_open:
            # Its members and other children are not all here: what its closed subtrees come to.
            parent = key_of(leaf.seq, d - 1) if d else None
            self.rows.append([key, parent, True, own, least, d, None, n, self.closed[c], self.below[c], self.saved[c], self.sha[c] or NOTHING])
            self.closed[c], self.below[c], self.saved[c] = 0, 0, 0
        else:
            leaves, saved = self.below[c] or 1, self.saved[c] + (n - 1) * own
            self.waiting[c] = [len(self.rows)]
            self.rows.append([None, None, False, own, least, d, None, n, self.children[c], leaves, saved, self.sha[c] or NOTHING])
            self.closed[c], self.below[c], self.saved[c] = 1, leaves, saved
        self.top[c], self.sha[c], self.children[c] = d - 1, None, 1
    def raised(self, c: int, depth: int) -> None:
        while self.top[c] > depth:
            self.passed(c)

    def joined(self, a: int, b: int, depth: int) -> None:
        a, b = self.find(a), self.find(b)
        self.raised(a, depth)
        self.raised(b, depth)
        self.up[b], self.end[a] = a, self.end[b]  # b lies behind a
        self.n[a] += self.n[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.sha[a] = self.sha[a] or self.sha[b]
        for x in (self.children, self.closed, self.below, self.saved):
            x[a] += x[b]
        few, many = sorted((self.waiting[a], self.waiting[b]), key=len)
        many += few
        self.waiting[a], self.waiting[b] = many, []

    def grown(self) -> list[list]:
        shared = [lcp(x.seq, y.seq) for x, y in zip(self.leaves, self.leaves[1:])]
        for i in sorted(range(len(shared)), key=lambda i: -shared[i]):
            self.joined(i, i + 1, shared[i])
        self.raised(0, 0)
        self.passed(0)
        return self.rows


def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each part of the sorted sequences; rows come by part, seq and first."""
    leaves: list[Leaf] = []
    part, sides = None, (0, 0)

    def made() -> Iterator[pa.RecordBatch]:
        rows = Forest(leaves, *sides).grown()
        for first in range(0, len(rows), 20_000):
            columns = list(zip(*rows[first : first + 20_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], names=NAMES)

    for batch in batches:
        for at, seq, sizes, ids, before, after in zip(*[batch.column(i) for i in range(6)]):
            at, seq = at.as_py(), seq.as_py()
            if at != part:
                if leaves:
                    yield from made()
                leaves, part, sides = [], at, (before.as_py(), after.as_py())
            if not leaves or leaves[-1].seq != seq:
                leaves.append(Leaf(seq, sizes.as_py()))
            leaves[-1].add(np.frombuffer(ids.as_py(), "<i8"))
    if leaves:
        yield from made()


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contracted tree: nodes come deepest first, and each adds itself to its parent."""
    under: dict[bytes, list[int]] = {}
    for batch in batches:
        rows = []
        for key, parent, own, conv, depth, n, children, leaves, saved, sha in zip(*[batch.column(i).to_pylist() for i in range(10)]):
            more = under.pop(key, (0, 0, 0))
            children, leaves, saved = children + more[0], leaves + more[1] or 1, saved + more[2] + (n - 1) * own
            if parent is not None:
                total = under.setdefault(parent, [0, 0, 0])
                for i, x in enumerate((1, leaves, saved)):
                    total[i] += x
            rows.append((key, parent, conv, depth, n, children, leaves, saved, sha))
        if rows:
            kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=CONTRACTED)


def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many turns a part's ends share with those of its neighbours."""
    for batch in batches:
        before, after = [], []
        for low, high, last, following in zip(*[batch.column(i).to_pylist() for i in range(1, 5)]):
            before.append(0 if last is None else lcp(last, low))
            after.append(0 if following is None else lcp(high, following))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(before, pa.int64()), pa.array(after, pa.int64())], names=["part", "before", "after"])


def trie(talks: DataFrame, per_part: int = PART) -> DataFrame:
    """A row per node of the trie of ``talks`` (conv_id, turns), see ``prefix_nodes``."""
    lines = written(sequences(talks), "sequences")
    runs = lines.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    runs = written(runs.mapInArrow(packed, "seq binary, bytes array<long>, first long, ids binary"), "packed")
    parts = -(-runs.count() // per_part)
    cut = runs.repartitionByRange(max(1, parts), "seq").withColumn("part", F.spark_partition_id())
    cut = written(cut, "sorted")

    ends = cut.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    around = Window.orderBy("part")  # a row per part
    ends = ends.select("part", "low", "high", F.lag("high").over(around).alias("last"), F.lead("low").over(around).alias("following"))
    sides = written(ends.mapInArrow(borders, "part int, before long, after long"), "borders")
    rows = cut.join(sides, "part").repartition("part").sortWithinPartitions("part", "seq", "first")
    rows = rows.select("part", "seq", "bytes", "ids", "before", "after")
    nodes = written(rows.mapInArrow(grown, MADE), "nodes")

    sums = [F.sum(c).alias(c) for c in SUMS]
    ended = F.coalesce(F.max(F.when(F.col("ends_sha256") != NOTHING, F.col("ends_sha256"))), F.lit(NOTHING)).alias("ends_sha256")
    merged = nodes.filter("open").groupBy("key", "parent_key", "own", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, ended)
    merged = merged.select("key", "parent_key", "own", "conv_id", "depth", *SUMS, "ends_sha256")
    # Two paths a part at most, whatever the number of conversations.
    spine = merged.repartition(1).sortWithinPartitions(F.col("depth").desc())
    spine = written(spine.mapInArrow(added_up, f"key binary, parent_key binary, {TOTALS}"), "contracted")

    parents = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    hung = nodes.filter("not open").drop("key", "open", "own")
    known = hung.filter("parent_key is null").select(RESULT)
    tops = hung.filter("parent_key is not null").drop("parent_conv_id").unionByName(spine.drop("key"))
    tops = tops.join(parents, "parent_key", "left").withColumnRenamed("parent", "parent_conv_id")
    return known.unionByName(tops.select(RESULT))


def prefix_nodes(talk: DataFrame, every: int = 5, heads: int = 9, per_part: int = PART) -> DataFrame:
    """A row per node of the trie of rebuilt conversations (see ``rebuilt``): conv_id (the smallest
    conversation that begins with the node's turns), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes of last texts that all members but one could share, over the
    subtree) and ends_sha256 (of the ids, ascending and joined by commas, of those that end here).

    ``talk`` has conv_id, turn, role and text. Null roles and texts are empty. Turns come in the
    order of their number, null first; turns of one number in the order of the MD5 of role and
    text, so repeated rows are turns that follow each other. Rows without a conv_id belong to no
    conversation. Other columns are not read; an empty table has no node, not even a root.

    A conversation is one row of 16 bytes a turn while it is sorted. The ids of conversations that
    are equal are hashed as a stream, in packed blocks."""
    return trie(rebuilt(talk, every, heads), per_part)
