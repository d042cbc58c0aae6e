"""Nearest neighbours by largest inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample and sent to every task; all vectors are sorted into its
leaves. A query walks the tree best bin first: a priority queue holds the branches by how large an
inner product they promise, and leaves are visited in that order. How many leaves, is calibrated:
for some queries the true neighbours are found by brute force, and the visits are widened until
their leaves hold the wanted share. Vectors and queries then meet leaf by leaf; large leaves are
dealt out in shards, so a leaf that holds most vectors is still many tasks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import written

#: Bound of the sample that the tree is fitted on, branches of a node, sample vectors of a leaf.
SAMPLE, BRANCHES, LEAF = 20_000, 16, 128
#: Share of true neighbours that calibration asks for, and the queries it takes.
RECALL, CALIBRATION = 0.96, 200
#: Vectors, and queries, of a leaf that meet in one task.
SHARD_ROWS, SHARD_QUERIES = 4096, 1 << 15
QUERY_BLOCK = 256
#: Rows of queries and leaves that a task passes on together.
ROUTED = 4096
TOGETHER = T.StructType([T.StructField(n, k) for n, k in (("query_id", T.LongType()), ("vec_id", T.LongType()), ("score", T.DoubleType()))])


@dataclass
class Tree:
    centers: np.ndarray
    radii: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # its number, or -1

    def visits(self, query: np.ndarray, most: int) -> Iterator[int]:
        """Leaves in the order of promise: best bin first."""
        promise = self.centers @ query + 0.5 * np.sqrt(query @ query) * self.radii
        queue = [(-promise[0], 0)]
        while queue and most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                most -= 1
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (-promise[child], child))

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest centres."""
        out = np.full(len(vectors), -1, np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            own = self.children[node]
            near = nearest(vectors[rows], self.centers[own])
            todo.extend((child, rows[near == k]) for k, child in enumerate(own) if (near == k).any())
        return out


def nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * vectors @ centers.T, axis=1)


def grow(vectors: np.ndarray, seed: int = 3) -> Tree:
    r = np.random.default_rng(seed)
    tree = Tree(np.zeros((0, 0)), np.zeros(0))
    centers, radii, leaves = [], [], 0
    todo: list[tuple[np.ndarray, int]] = [(np.arange(len(vectors)), -1)]
    while todo:
        rows, parent = todo.pop()
        own = vectors[rows]
        center = own.mean(axis=0)
        node = len(centers)
        centers.append(center)
        radii.append(np.sqrt(((own - center) ** 2).sum(axis=1).mean()))
        tree.children.append([])
        tree.leaf.append(-1)
        if parent >= 0:
            tree.children[parent].append(node)
        parts = []
        if len(rows) > LEAF:
            means = own[r.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
            for _ in range(12):
                near = nearest(own, means)
                means = np.stack([own[near == k].mean(axis=0) if (near == k).any() else means[k] for k in range(len(means))])
            near = nearest(own, means)
            parts = [rows[near == k] for k in range(len(means)) if (near == k).any()]
        if len(parts) > 1:
            todo.extend((part, node) for part in parts)
        else:
            tree.leaf[node] = leaves
            leaves += 1
    tree.centers, tree.radii = np.array(centers), np.array(radii)
    return tree


def best(ids: np.ndarray, vectors: np.ndarray, own_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """For some queries the k ids of largest inner product, own ids left out, ties to smaller ids:
    (place of the query, id, product). The matrix product is right up to rounding; those that can
    matter are summed again in a fixed order, so equal vectors have equal scores."""
    rough = queries @ vectors.T
    rough[own_ids[:, None] == ids[None, :]] = -np.inf
    if rough.shape[1] > k:
        edge = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
        near = rough >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None]
    else:
        near = np.ones(rough.shape, bool)
    near &= rough > -np.inf
    at, row = np.nonzero(near)
    exact = np.empty(len(at))
    for a in range(0, len(at), 1 << 16):
        part = slice(a, a + (1 << 16))
        exact[part] = (vectors[row[part]] * queries[at[part]]).sum(axis=1)
    order = np.lexsort((ids[row], -exact, at))
    at, row, exact = at[order], row[order], exact[order]
    first = np.searchsorted(at, at, "left")
    kept = np.arange(len(at)) - first < k
    return at[kept], ids[row[kept]], exact[kept]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors from binary columns of 32-bit or 64-bit numbers, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Not null, not zero, no component null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def packed(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec) with usable vectors of the most frequent length as bytes of doubles."""
    source = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(embedding)))
    lengths = source.groupBy(F.size(embedding).alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).limit(1)
    usual = (lengths.first() or {"n": 0})["n"]
    source = source.filter(F.size(embedding) == usual)
    source = source.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
            edges = (8 * (lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py())).tolist()
            vec = pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), vec], names=["vec_id", "vec"])

    return source.mapInArrow(pack, "vec_id long, vec binary")


def searched(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    recall: float = RECALL,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample_rows: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
    shard_queries: int = SHARD_QUERIES,
) -> DataFrame:
    """For each usable vector that ``queries`` holds for: query_id, rank, vec_id, score of the k
    nearest found among all others.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do null
    ids; of vectors of several lengths those of the most frequent one do (of two the longer). A query never finds its own id; rows that repeat an id
    are candidates each. With k candidates or fewer all are found. Equal scores go by the smaller
    id. Other columns are not read; an empty table gives no rows. The vectors are written to the
    shared folder with their leaf, as they are needed several times."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = packed(vectors, vec_id, embedding)
    sample = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(sample_rows).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], result)
    fitted = matrix(sample["vec"])
    tree = grow(fitted)
    shared = spark.sparkContext.broadcast(tree)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(shared.value.home(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["vec_id", "vec", "leaf"])

    homed = written(rows.mapInArrow(home, "vec_id long, vec binary, leaf long"), "leaves")
    visits = calibrated(homed, sample["vec_id"].to_pylist()[:CALIBRATION], fitted[:CALIBRATION], tree, k, recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch, at: list[int], leaf: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, pa.array(leaf, pa.int64())], names=["query_id", "query", "leaf"])

        for batch in batches:
            at, leaf = [], []
            for i, query in enumerate(matrix(batch.column(1))) if batch.num_rows else ():
                found = list(shared.value.visits(query, visits))
                at.extend([i] * len(found))
                leaf.extend(found)
                if len(at) >= ROUTED:
                    yield rows(batch, at, leaf)
                    at, leaf = [], []
            yield rows(batch, at, leaf)

    # a row per leaf, and leaves are bounded by the sample
    shards = homed.groupBy("leaf").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    shards = F.broadcast(shards)
    dealt = homed.join(shards, "leaf").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    asked = homed.filter(queries).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")).distinct()
    # No group has more than so many queries: they are dealt in blocks, and each shard meets each block.
    blocks = 1 + homed.filter(queries).count() // shard_queries
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.mapInArrow(route, "query_id long, query binary, leaf long").join(shards, "leaf")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks)).cast("int"))

    def meet(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and asking.num_rows:
            ids, vecs = candidates["vec_id"].to_numpy(), matrix(candidates["vec"])
            query_ids, query_vecs = asking["query_id"].to_numpy(), matrix(asking["query"])
            for first in range(0, len(query_ids), QUERY_BLOCK):
                part = slice(first, first + QUERY_BLOCK)
                at, near, score = best(ids, vecs, query_ids[part], query_vecs[part], k)
                for name, values in (("query_id", query_ids[part][at]), ("vec_id", near), ("score", score)):
                    found[name].append(values)
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in found.items()})

    met = (
        dealt.select("leaf", "shard", "block", "vec_id", "vec").groupBy("leaf", "shard", "block")
        .cogroup(asked.select("leaf", "shard", "block", "query_id", "query").groupBy("leaf", "shard", "block"))
        .applyInArrow(meet, TOGETHER)
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def calibrated(homed: DataFrame, ids: list[int], queries: np.ndarray, tree: Tree, k: int, recall: float) -> int:
    """Leaves to visit so that they hold the wanted share of the calibration queries' true
    neighbours, found by brute force over all vectors."""

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, vecs = batch.column(0).to_numpy(), matrix(batch.column(1))
            leaf_of = batch.column(2).to_numpy()
            where = np.arange(len(own))
            for i, rough in enumerate(queries @ vecs.T):
                rough = np.where(own == ids[i], -np.inf, rough)
                rows = where if len(own) <= k else np.argpartition(-rough, k)[:k]
                rows = rows[own[rows] != ids[i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), i)), pa.array(rough[rows]), pa.array(own[rows]), pa.array(leaf_of[rows])],
                    names=["query", "score", "vec_id", "leaf"],
                )

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    true = homed.mapInArrow(brute, "query long, score double, vec_id long, leaf long")
    true = true.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "leaf").collect()
    leaves = sum(1 for leaf in tree.leaf if leaf >= 0)
    place = [{leaf: n for n, leaf in enumerate(tree.visits(query, leaves), 1)} for query in queries]
    needed = sorted(place[row["query"]][row["leaf"]] for row in true)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] if needed else leaves
