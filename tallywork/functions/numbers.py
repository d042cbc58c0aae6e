"""Ratios, growth and bands with one rounding rule: half away from zero, worked
out on decimals so that a result never depends on the order of a float sum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def ratio(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` rounded to ``scale`` digits; NULL when ``den`` is zero.

    Both sides must be whole numbers or have two decimals."""
    top = num.cast("decimal(28,2)")
    bottom = F.nullif(den.cast("decimal(22,2)"), F.lit(0).cast("decimal(22,2)"))
    return F.round(top / bottom, scale)


def percent(part: Column, whole: Column, scale: int) -> Column:
    return ratio(part.cast("decimal(26,2)") * F.lit(100), whole, scale)


def growth_percent(before: Column, after: Column, scale: int) -> Column:
    """``(after - before) / before`` in percent; NULL when ``before`` is zero."""
    return percent(after - before, before, scale)


def upper_inclusive_band(value: Column, width: int) -> Column:
    """Label of the band: ``0-30``, ``31-60``, ... (the upper edge belongs to it)."""
    band = F.greatest(F.ceil(value / F.lit(width)), F.lit(1)).cast("int")
    low = F.when(band == 1, F.lit(0)).otherwise((band - 1) * width + 1)
    return F.concat(low.cast("string"), F.lit("-"), (band * width).cast("string"))


def logical_size(col: Column, dtype: str) -> Column:
    """Bytes of one value: fixed per type, the byte length for text."""
    widths = {"int": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "boolean": 1}
    if dtype == "string":
        return F.octet_length(col)
    if dtype.startswith("decimal"):
        precision = int(dtype.split("(")[1].split(",")[0])
        width = 8 if precision <= 18 else 16
    else:
        width = widths[dtype]
    return F.when(col.isNotNull(), F.lit(width))
