"""Slices of an order: what a window over a key of any size is worked out from.

``in_slices`` deals rows out by ranges of key and order, so that a slice has about as many rows as
any other and a large key has many slices. Their number is that of the shuffle's partitions, which
follows the data, not a constant. What a slice must know of those before it (a running sum, a last
value) is carried over by a window that sees one row per key and slice. The dealt rows are written
to the checkpoint folder: a task that runs again finds every row in the slice it was in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.operators.skew import join_on, ordering
from tallywork.sources.tables import cut_lineage


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` with ``_slice``: rows of a key in a smaller slice come first in ``order`` (NULLs last).

    Rows equal in key and order share a slice. Written once."""
    by = ordering([*keys, *order])
    dealt = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return cut_lineage(dealt.withColumn("_slice", F.spark_partition_id()))


def carried(sliced: DataFrame, keys: Sequence[str], sums: dict[str, Column], totals: bool = False) -> DataFrame:
    """A row per key and slice: each sum over the key's earlier slices (``_before_x``) and, if asked
    for, over the whole key (``_total_x``)."""
    per_slice = sliced.groupBy(*keys, "_slice").agg(*[c.alias(f"_own_{name}") for name, c in sums.items()])
    window = Window.partitionBy(*keys)
    earlier = window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    columns = {f"_before_{n}": F.coalesce(F.sum(f"_own_{n}").over(earlier), F.lit(0)) for n in sums}
    if totals:
        columns |= {f"_total_{n}": F.sum(f"_own_{n}").over(window) for n in sums}
    return per_slice.withColumns(columns).drop(*[f"_own_{n}" for n in sums])


def within(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, "_slice").orderBy(*ordering(order))


def running_sum(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum over the key's rows up to and with this one; ``order`` free of ties. NULLs add nothing."""
    known = F.coalesce(value, F.lit(0))
    before = carried(sliced, keys, {"x": F.sum(known)})
    frame = within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = sliced.withColumn("_own", F.sum(known).over(frame))
    return join_on(own, before, [*keys, "_slice"]).withColumn(name, F.col("_own") + F.col("_before_x")).drop("_own", "_before_x")


def numbered(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` inside the key, as bigint."""
    before = carried(sliced, keys, {"n": F.count(F.lit(1))})
    own = sliced.withColumn("_own", F.row_number().over(within(keys, order)).cast("bigint"))
    return join_on(own, before, [*keys, "_slice"]).withColumn(name, F.col("_own") + F.col("_before_n")).drop("_own", "_before_n")


def last_known(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """The latest non-NULL value up to and with this row: ``values`` maps new names to columns."""
    frame = within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct(*[part for c in order for part in (F.col(c).isNull(), F.col(c))])
    ends = {new: F.max_by(F.col(old), F.when(F.col(old).isNotNull(), place)) for new, old in values.items()}
    per_slice = sliced.groupBy(*keys, "_slice").agg(*[c.alias(f"_end_{new}") for new, c in ends.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(*keys, "_slice", *[F.last(f"_end_{new}", ignorenulls=True).over(earlier).alias(f"_before_{new}") for new in values])
    own = sliced.withColumns({f"_own_{new}": F.last(old, ignorenulls=True).over(frame) for new, old in values.items()})
    joined = join_on(own, before, [*keys, "_slice"])
    found = joined.withColumns({new: F.coalesce(f"_own_{new}", f"_before_{new}") for new in values})
    return found.drop(*[f"{side}_{new}" for new in values for side in ("_own", "_before")])


def rows_frame(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], aggregates: dict[str, Column], preceding: int, following: int, rows: int = 1_000_000
) -> DataFrame:
    """Aggregates over the ROWS from ``preceding`` rows before to ``following`` rows after, on raw
    rows of keys of any size. ``order`` must be free of ties inside a key.

    Rows are numbered and cut into runs of ``rows`` (or of the frame, if that is longer). A run
    gets copies of the rows just before and after it, and no more: its frames end there."""
    size = max(rows, preceding, following, 1)
    numbered_rows = numbered(in_slices(df, keys, order), keys, order, "_at")
    run, place = F.floor((F.col("_at") - 1) / size), F.pmod(F.col("_at") - 1, F.lit(size))
    to = F.array_compact(
        F.array(
            F.struct(run.alias("run"), F.lit(True).alias("own")),
            F.when(place >= size - preceding, F.struct((run + 1).alias("run"), F.lit(False).alias("own"))),
            F.when(place < following, F.struct((run - 1).alias("run"), F.lit(False).alias("own"))),
        )
    )
    dealt = numbered_rows.withColumn("_to", F.explode(to))
    frame = Window.partitionBy(*keys, "_to.run").orderBy("_at").rowsBetween(-preceding, following)
    found = dealt.withColumns({name: c.over(frame) for name, c in aggregates.items()})
    return found.filter("_to.own").drop("_to", "_at", "_slice")


def running_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum over the ROWS from the first one on, on raw rows of keys of any size."""
    return running_sum(in_slices(df, keys, order), keys, order, value, name).drop("_slice")
