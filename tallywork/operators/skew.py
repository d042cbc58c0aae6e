"""Windows over keys of which one may hold a large part of all rows.

A plain ``Window.partitionBy(key)`` sorts every row of a key in one task. The
operators here keep the work of one task bounded whatever the keys look like:

* ``running_total`` and ``value_rank`` first add up the rows that share one
  ordering value. The window then sees one row per key and value (for dates, one
  per day), and the answer is joined back on key *and* value.
* ``number_rows`` and ``shift_rows`` need the single rows. Every key is cut into
  slices of the ordering, and each slice gets one extra row that carries over what
  it must know of its neighbour. No key is counted to see whether it is large.
* ``join_salted`` spreads the facts of hot keys over several copies of the row they
  are joined with. Adaptive execution splits a skewed join too, but not when the
  join feeds a window or a grouping on the same key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key above this many rows is salted in ``join_salted``; the answer is the same
# below and above. A table of N rows has fewer than N / HOT_ROWS such keys.
HOT_ROWS = 5_000_000


def join_on(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL matches NULL; the right copy of the keys is dropped."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in columns])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in columns])


def full_join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full outer join in which NULL matches NULL; a key comes from the side that has it."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in columns])
    joined = left.join(renamed, condition, "full")
    keys = [F.coalesce(left[c], renamed[f"_r_{c}"]).alias(c) for c in columns]
    others = [left[c] for c in left.columns if c not in columns] + [right[c] for c in right.columns if c not in columns]
    return joined.select(*keys, *others)


def ordering(columns: Sequence[str], descending: bool = False) -> list[Column]:
    """Sort order with NULLs last going up and first going down."""
    return [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in columns]


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (counted map-side first)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows).select(*keys)


def nulls_last(columns: Sequence[Column]) -> Column:
    """A sort key that puts NULLs last: for each column whether it is NULL, then its value."""
    parts = [part for c in columns for part in (c.isNull(), c)]
    return F.struct(*[part.alias(f"s{i}") for i, part in enumerate(parts)])


def join_salted(
    facts: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = 256,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Inner or left equi join of facts with few rows per key on the right.

    Hot keys are those of ``counted``, a narrower table with the same keys, so that the facts need
    not be read to find them; without one the facts are counted. Which keys are hot changes no
    row. The salt is a hash of the whole fact, so a task that runs again sends every fact
    to the same place."""
    hot = F.broadcast(hot_keys(facts if counted is None else counted, keys, hot_rows).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    spread = F.col("_hot")
    for key in keys:  # rows without a key match nothing and may all be spread
        spread = F.coalesce(spread, F.lit(False)) | F.col(key).isNull()
    left = facts.join(hot, list(keys), "left").withColumn("_salt", F.when(spread, salt).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = rows.join(hot, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def running_total(df: DataFrame, keys: Sequence[str], order: str, measure: Column, name: str) -> DataFrame:
    """Running sum in which rows equal in ``order`` share the value (RANGE frame)."""
    totals = running_series(df, keys, order, measure, name).select(*keys, order, name)
    return join_on(df, totals, [*keys, order])


def running_series(df: DataFrame, keys: Sequence[str], order: str, measure: Column, name: str) -> DataFrame:
    """One row per key and ordering value: row count and running sum up to it."""
    per_value = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("_total"))
    window = Window.partitionBy(*keys).orderBy(*ordering([order]))
    return per_value.withColumn(name, F.sum("_total").over(window)).drop("_total")


def value_rank(
    df: DataFrame, keys: Sequence[str], order: str, name: str, descending: bool = False, dense: bool = False
) -> DataFrame:
    """``rank`` / ``dense_rank`` of every row inside its key, as bigint."""
    per_value = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_rows"))
    window = Window.partitionBy(*keys).orderBy(*ordering([order], descending))
    if dense:
        rank = F.row_number().over(window)
    else:
        before = F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1))
        rank = F.coalesce(before, F.lit(0)) + 1
    return join_on(df, per_value.select(*keys, order, rank.cast("bigint").alias(name)), [*keys, order])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: Sequence[Column]) -> DataFrame:
    """``row_number`` inside a key, as bigint, NULLs last. ``slices`` must not fall while
    ``order`` rises, and be NULL only where the leading order column is."""
    pieces = df.withColumn("_slice", nulls_last(slices))
    counts = pieces.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        counts.withColumn("_step", F.sum("_rows").over(earlier)).filter(F.col("_step").isNotNull()).drop("_rows")
    )
    rows = pieces.withColumns({"_step": F.lit(1).cast("bigint"), "_real": F.lit(1)})
    rows = rows.unionByName(carried.withColumn("_real", F.lit(0)), allowMissingColumns=True)
    window = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_real", *ordering(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = rows.withColumn(name, F.sum("_step").over(window))
    return numbered.filter(F.col("_real") == 1).drop("_step", "_real", "_slice")


def shift_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    slices: Sequence[Column],
    forward: bool = True,
) -> DataFrame:
    """``lead`` (forward) or ``lag`` by one row: ``values`` maps new names to columns.

    NULLs in ``order`` come last. ``order`` must be free of ties inside a key; ``slices``
    must not fall while it rises, and be NULL only where an order column is."""
    pieces = df.withColumn("_slice", nulls_last(slices))
    carried_columns = list(dict.fromkeys([*order, *values.values()]))
    row, place = F.struct(*carried_columns), nulls_last([F.col(c) for c in order])
    edge = F.min_by(row, place) if forward else F.max_by(row, place)
    edges = pieces.groupBy(*keys, "_slice").agg(edge.alias("_edge"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    neighbour = F.lead("_edge").over(by_slice) if forward else F.lag("_edge").over(by_slice)
    carried = (
        edges.withColumn("_row", neighbour)
        .filter(F.col("_row").isNotNull())
        .select(*keys, "_slice", "_row.*", F.lit(False).alias("_real"))
    )
    rows = pieces.withColumn("_real", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "_slice").orderBy(*ordering(order))
    step = F.lead if forward else F.lag
    shifted = rows.withColumns({new: step(old).over(window) for new, old in values.items()})
    return shifted.filter("_real").drop("_real", "_slice")
