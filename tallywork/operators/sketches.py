"""Distinct counts of any span and any grouping: from mergeable sketches, or exactly from bitmaps.

Counts of distinct values do not add up; sketches and bitmaps do. Both are made once per day (or
any other finest key), stored, and merged over whatever days and groups are asked for, without
reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the number of registers of a sketch.
REGISTERS = 12


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, registers: int = REGISTERS) -> DataFrame:
    """A HyperLogLog sketch of the distinct values per key; NULLs don't count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, registers).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Approximate distinct counts of coarser keys, from stored sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def distinct_error(registers: int = REGISTERS) -> float:
    """Three standard errors, relative to the count (union of sketches)."""
    return 3 * 1.04 / 2 ** (registers / 2)


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The distinct whole numbers per key as bitmaps of 32768 numbers each: keys, part, bits. NULLs
    don't count. A bitmap is 4 kB however few bits are set, so ids should lie close together."""
    known = df.filter(F.col(value).isNotNull())
    part, bit = F.bitmap_bucket_number(value), F.bitmap_bit_position(value)
    return known.groupBy(*keys, part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def merged_bits(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts of coarser keys: the parts of a key are merged apart, then added up."""
    parts = bitmaps.groupBy(*keys, "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_bits"))
    return parts.groupBy(*keys).agg(F.sum("_bits").alias(name))


def cube_distinct(df: DataFrame, dimensions: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact distinct counts for every subset of the dimensions (CUBE), and which dimensions a row
    is summed over (``grouping_id``). Rows are read once into bitmaps of the finest groups; only
    bitmaps are copied to the coarser ones."""
    finest = distinct_bitmaps(df, dimensions, value)
    ids = list(range(2 ** len(dimensions)))
    level = finest.withColumn("grouping_id", F.explode(F.array(*[F.lit(i) for i in ids])))
    over = {d: F.when(F.col("grouping_id").bitwiseAND(F.lit(1 << (len(dimensions) - 1 - i))) == 0, F.col(d)) for i, d in enumerate(dimensions)}
    return merged_bits(level.withColumns(over), [*dimensions, "grouping_id"], name)


def divided(df: DataFrame, key: str, value: str, every: DataFrame, name: str) -> DataFrame:
    """Relational division: the keys that have every number of ``every`` (one column), with their
    number of distinct values. Part by part, a key has all of them when its bitmap, merged with the
    divisor's, has no bit more."""
    own = distinct_bitmaps(df, [key], value)
    whole = distinct_bitmaps(every.toDF("_value"), [], "_value").select("part", F.col("bits").alias("_all"))
    both = own.join(whole, "part").select(key, "part", F.bitmap_count("bits").alias("_own"), F.explode(F.array("bits", "_all")).alias("_bits"))
    merged = both.groupBy(key, "part", "_own").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_both"))
    sums = merged.groupBy(key).agg(F.sum("_own").alias("_own"), F.sum("_both").alias("_both"), F.count(F.lit(1)).alias("_parts"))
    parts = whole.agg(F.count(F.lit(1))).scalar()
    complete = sums.filter((F.col("_own") == F.col("_both")) & (F.col("_parts") == parts))
    return merged_bits(own, [key], name).join(complete, key, "left_semi")
