"""Range joins without an equal key: points in intervals.

The line is cut into bins; a point lies in one, an interval is copied to each bin it meets, and the
join is on the bin, with the exact condition behind it. The width of a bin comes from the data: so
many points per bin, but no less than the mean length of an interval, so that an interval has few
copies. An interval is clipped to the points; a long one costs a copy only for bins it covers, whose
points it returns. A bin that holds many points is split by a hash of the point, and its intervals
are copied to each part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.sources.tables import cut_lineage

#: Points that one task meets an interval with.
POINTS = 200_000


def line(value: Column, kind: str) -> Column:
    """A place on the line as a double: numbers, dates (days) and timestamps (seconds)."""
    if kind == "date":
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")) / F.lit(1e6)
    return value.cast("double")


def in_intervals(
    points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, closed: bool = True, per_bin: int = POINTS
) -> DataFrame:
    """Every point with every interval it lies in: ``low <= at <= high``, or ``at < high`` if not
    ``closed``. All columns of both, whose names must differ.

    NULLs, and intervals that end before they begin, match nothing; a NULL ``high`` is an open end.
    Points that are equal are split by their other columns."""
    kind = dict(points.dtypes)[at]
    place = points.filter(F.col(at).isNotNull()).withColumn("_x", line(F.col(at), kind))
    span = place.agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).first()
    joined_columns = [*points.columns, *intervals.columns]
    upper = F.coalesce(line(F.col(high), kind), F.lit(span["high"]).cast("double"))
    known = intervals.filter(F.col(low).isNotNull()).withColumns({"_low": F.greatest(line(F.col(low), kind), F.lit(span["low"]).cast("double")), "_high": F.least(upper, F.lit(span["high"]).cast("double"))})
    known = known.filter(F.col("_low") <= F.col("_high"))
    mean = known.agg(F.avg(F.col("_high") - F.col("_low")).alias("x")).first()["x"]
    extent = (span["high"] - span["low"]) if span["n"] else 0.0
    # Bins are counted from the first point; at most one per so many points, or per mean interval.
    bins = max(1, span["n"] // per_bin)
    width = max(extent / bins, min(mean or 0.0, extent)) or 1.0

    def bin_of(x: Column) -> Column:
        return F.floor((x - F.lit(span["low"] or 0.0)) / F.lit(width)).cast("long")

    dealt = place.withColumn("_bin", bin_of(F.col("_x")))
    counts = dealt.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"))
    parts = cut_lineage(counts.select("_bin", F.greatest(F.lit(1), F.ceil(F.col("_n") / per_bin)).cast("long").alias("_parts")))
    left = dealt.join(parts, "_bin").withColumn("_part", F.pmod(F.xxhash64(*points.columns), F.col("_parts")))
    copies = known.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_low")), bin_of(F.col("_high")))))
    right = copies.join(parts, "_bin").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    end = (F.col(at) <= F.col(high)) if closed else (F.col(at) < F.col(high))
    inside = (F.col(at) >= F.col(low)) & (F.col(high).isNull() | end)
    return left.drop("_parts", "_x").join(right, ["_bin", "_part"]).filter(inside).select(*joined_columns)
