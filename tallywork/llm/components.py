"""Connected components of a table of edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import written


def small_star(edges: DataFrame) -> DataFrame:
    """Every vertex hangs its smaller neighbours, and itself, on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    pair = F.when(F.col("b") == F.col("m"), F.struct("a", F.col("m").alias("b"))).otherwise(F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return joined.select(pair.alias("e")).select("e.a", "e.b").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hangs its larger neighbours on the least of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftrightunsigned(hashed, 24))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex that isn't the least of its component, with the least.

    ``edges`` has columns a and b with a > b. Only counts and checksums reach the driver; every
    round is written to the shared folder. The rounds grow with the logarithm of the largest
    component; they end when the edges no longer change."""
    now = written(edges.select("a", "b").distinct(), "edges")
    before = None
    while (found := state(now)) != before:
        before = found
        now = written(small_star(large_star(now)), "edges")
    return now
