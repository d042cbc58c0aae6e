"""Exact medians and rank percentiles without a window over all rows.

Rows are first counted per distinct value. Positions then come from running counts
over that histogram: directly where the values are few (whole days), or in slices
of it where nearly every row has its own value. A slice knows how many rows lie
below it, so that every rank is exact. Beside them a mergeable sketch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.numbers import ratio
from tallywork.operators.skew import join_on
from tallywork.operators.slices import carried, in_slices, within


def histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
    return counted.agg(F.count(F.lit(1)).alias("n"))


def positions(hist: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``below`` (rows with a smaller value) and ``total``; for few distinct values per key."""
    window = Window.partitionBy(*keys)
    before = window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(before), F.lit(0))
    return hist.withColumns({"below": below, "total": F.sum("n").over(window)})


def sliced_positions(hist: DataFrame, value: str, keys: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """The same for any number of distinct values per key: the histogram is cut into slices, as
    many as its size asks for, and each knows how many rows of the key lie below it."""
    sliced = in_slices(hist, list(keys), [value], slices)
    before = carried(sliced, list(keys), {"n": F.sum("n")}, totals=True)
    frame = within(list(keys), [value]).rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumn("below", F.coalesce(F.sum("n").over(frame), F.lit(0)))
    joined = join_on(own, before, [*keys, "_slice"]).withColumns({"below": F.col("below") + F.col("_before_n"), "total": F.col("_total_n")})
    return joined.drop("_slice", "_before_n", "_total_n")


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], slices: int | None = None) -> DataFrame:
    """Exact percentiles per key, as ``percentile_cont`` (``x_cont``: between the two nearest rows,
    in double precision) and ``percentile_disc`` (``x_disc``: the first value that ``x`` of the rows
    do not exceed) for every named share. NULLs don't count; a key without values has no row."""
    located = sliced_positions(histogram(df, keys, value), value, keys, slices)
    total, first = F.col("total"), F.col("below")
    last = first + F.col("n") - 1
    columns = []
    for name, share in shares.items():
        place = (total - 1) * F.lit(share)
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place)), ("disc", F.greatest(F.ceil(total * F.lit(share)), F.lit(1)) - 1)):
            hit = (first <= at) & (at <= last)
            columns.append(F.max(F.when(hit, F.col(value))).alias(f"{name}_{side}"))
    found = located.groupBy(*keys).agg(F.max("total").alias("rows"), *columns)
    out = []
    for name, share in shares.items():
        low, high = F.col(f"{name}_lo").cast("double"), F.col(f"{name}_hi").cast("double")
        place = (F.col("rows") - 1) * F.lit(share)
        out += [(low + (high - low) * (place - F.floor(place))).alias(f"{name}_cont"), F.col(f"{name}_disc")]
    return found.select(*keys, "rows", *out)


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = 400) -> DataFrame:
    """A mergeable sketch (KLL) of a value per key. A quantile read from it is a value whose rank is
    right within ``kll_error(k)`` of the rows with 99 % confidence."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def kll_error(k: int = 400) -> float:
    """Rank error of one quantile with 99 % confidence, as published with the sketch."""
    return 2.296 / k**0.9021


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Approximate percentiles of coarser keys from stored sketches, without the rows."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    read = [F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(f"{name}_approx") for name, share in shares.items()]
    return merged.select(*keys, F.kll_sketch_get_n_double("sketch").alias("rows"), *read)


def median(located: DataFrame, value: str, name: str) -> DataFrame:
    """Exact median of all rows (mean of the middle two for an even number)."""
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    first, last = F.col("below") + 1, F.col("below") + F.col("n")
    middle = located.filter((first <= high) & (last >= low))
    return middle.agg(ratio(F.min(value) + F.max(value), F.lit(2), 3).alias(name))


def rank_share_means(located: DataFrame, value: str, whole: Column, shares: Sequence[int]) -> DataFrame:
    """Mean of the values whose ``rank / whole`` rounds to one of the given percents."""
    share = F.floor((F.lit(200) * (F.col("below") + 1) + whole) / (F.lit(2) * whole)).cast("int")
    hits = located.withColumn("percentile", share).filter(F.col("percentile").isin(*shares))
    sums = hits.groupBy("percentile").agg(F.sum(F.col(value) * F.col("n")).alias("s"), F.sum("n").alias("n"))
    return sums.select("percentile", ratio(F.col("s"), F.col("n"), 0).alias("revenue"))


def band_means(located: DataFrame, keys: Sequence[str], value: str, shares: Sequence[int]) -> DataFrame:
    """Per key: the median (as percentile 50), and for each share the mean of the rows
    whose ``row_number / total`` rounds to it."""
    total = F.col("total")

    def edge(half_percents: int) -> Column:
        # First row number whose percent is at least half_percents / 2.
        return F.floor((total * half_percents + 199) / 200)

    bands = [
        F.struct(
            F.lit(50).alias("percentile"), F.floor((total + 1) / 2).alias("lo"), F.floor((total + 2) / 2).alias("hi")
        )
    ]
    for share in shares:
        bands.append(
            F.struct(
                F.lit(share).alias("percentile"),
                edge(2 * share - 1).alias("lo"),
                (edge(2 * share + 1) - 1).alias("hi"),
            )
        )
    rows = located.withColumn("b", F.explode(F.array(*bands)))
    first, last = F.greatest(F.col("below") + 1, F.col("b.lo")), F.least(F.col("below") + F.col("n"), F.col("b.hi"))
    weighted = rows.withColumn("w", last - first + 1).filter(F.col("w") > 0)
    sums = weighted.groupBy(*keys, F.col("b.percentile").alias("percentile")).agg(
        F.sum(F.col(value) * F.col("w")).alias("s"), F.sum("w").alias("w")
    )
    return sums.select(*keys, "percentile", ratio(F.col("s"), F.col("w"), 2).alias(f"avg_{value}"))
