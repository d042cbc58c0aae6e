"""Adjacency lists: three fixed levels by joins, any depth by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.sources.tables import cut_lineage


def flatten_three_levels(nodes: DataFrame, prices: DataFrame) -> DataFrame:
    """Leaf with its price, its two ancestors and a combined name."""
    top = nodes.select(F.col("id").alias("category_id"), F.col("level_text").alias("category_name"))
    middle = nodes.select(
        F.col("id").alias("segment_id"), F.col("parent_id").alias("category_id"), F.col("level_text").alias("segment_name")
    )
    leaf = nodes.select(
        F.col("id").alias("style_id"), F.col("parent_id").alias("segment_id"), F.col("level_text").alias("style_name")
    )
    priced = prices.withColumnRenamed("id", "style_id")
    joined = leaf.join(priced, "style_id").join(middle, "segment_id").join(top, "category_id")
    name = F.concat("style_name", F.lit(" "), "segment_name", F.lit(" - "), "category_name")
    return joined.select(
        "product_id", "price", name.alias("product_name"), "category_id", "segment_id", "style_id",
        "category_name", "segment_name", "style_name",
    )


def jumped(now: DataFrame, combined: dict) -> DataFrame:
    """Every row that has an ancestor to go to takes over from it, with ``combined`` columns of both
    (the ancestor's begin with an underscore); rows at their root stay."""
    ancestor = now.select(*[F.col(c).alias(f"_{c}") for c in now.columns])
    going = now.filter(F.col("up").isNotNull()).join(ancestor, F.col("up") == F.col("_id"))
    going = going.select("id", F.col("_up").alias("up"), *[c.alias(name) for name, c in combined.items()])
    return now.filter(F.col("up").isNull()).select(going.columns).unionByName(going)


def depths(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(id, root_id, depth) of every node below a root, and the number of rounds it took.

    In round n a node jumps over 2**n ancestors. Depths have no gaps, so the first round in which no
    node comes to a root is the last. A walk with more steps than there are rows is a cycle below a
    root (of a node with two parents) and an error."""
    now = nodes.select("id", F.col("parent_id").alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("id").alias("root_id"))
    rows, before, rounds = None, 0, 0
    while True:
        now = cut_lineage(now)
        rows = now.count() if rows is None else rows
        looped = F.min(F.when(F.col("up").isNull() & (F.col("depth") > rows), F.col("id"))).alias("looped")
        found = now.agg(F.count_if(F.col("up").isNull()).alias("n"), F.count("up").alias("going"), looped).first()
        if found["looped"] is not None:
            raise ValueError(f"the hierarchy has a cycle at node {found['looped']}")
        if found["n"] == before or not found["going"]:
            home = now.filter(F.col("up").isNull())
            return home.select("id", "root_id", F.col("depth").cast("int").alias("depth")), rounds
        before, rounds = found["n"], rounds + 1
        now = jumped(now, {"depth": F.col("depth") + F.col("_depth"), "root_id": F.col("_root_id")})


def paths(nodes: DataFrame, sep: str = " > ") -> DataFrame:
    """Root, depth and path of every node below a root, for any number of levels.

    Pointer doubling: a chain of a thousand levels takes ten rounds, each written to the checkpoint
    folder. The ids alone go first and find cycles, before any text grows. A node whose parents lead
    to no root has no path."""
    known, rounds = depths(nodes)
    below = nodes.join(known.select("id").distinct(), "id", "left_semi")
    now = below.select("id", F.col("parent_id").alias("up"), F.col("id").alias("root_id"), F.lit(1).alias("depth"), F.col("level_text").alias("path"))
    for _ in range(rounds):
        now = jumped(now, {"root_id": F.col("_root_id"), "depth": F.col("depth") + F.col("_depth"), "path": F.concat_ws(sep, "_path", "path")})
        now = cut_lineage(now)
    return now.filter(F.col("up").isNull()).select("id", "root_id", "depth", "path")
