"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import WORD, text_of, without

RESULT = ("size", "source_size", "target", "copies", "taken")


def targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """Adds ``target`` to a row per source with ``source`` and ``source_size``.

    The sum of all sizes is shared out by weight; a target stops at ``most`` times its source's
    size and the rest is shared again among the others. In the end every source has
    min(most * size, level * weight) for one level. In the order of most * size / weight the
    sources that stop come first, so the level follows from running sums. The windows run over
    one row per source, not over documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy("stop", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("stop", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(by_stop), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_stop), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("weight_left"))
    )
    # the first source that doesn't stop has the level of all that follow; later ones say less
    level = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    return ranked.select("source", "source_size", F.least("limit", F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def coin(*columns: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the values alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(
    docs: DataFrame, weights: list[float], most: float = 3.0, seed: int = 7, doc_id: str = "doc_id",
    text: str = "text", source: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies times size).

    A document of a source with rate r = target / source_size is taken floor(r) times, and once
    more with the probability of the fraction, decided by a hash of its id. Sizes are words;
    null texts have none. Null is a source of its own, the last in order. A source without words
    has target 0 and rate 0. Rows that repeat get the same number of copies. Columns of ``docs``
    that are named like a result are replaced; an empty table gives no rows.

    Sources are summed map-side, and the rates (a row per source) come back by a join that
    adaptive execution may broadcast or split, so a source with most rows stays spread."""
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    sized = without(docs, *RESULT).withColumn("size", size)
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    rates = targets(sizes, weights, most).withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    extra = (coin(F.col(doc_id), seed=seed) < rate - F.floor(rate)).cast("long")
    joined = sized.join(rates, sized[f"`{source}`"].eqNullSafe(rates["__source"])).drop("__source")
    return joined.withColumn("copies", F.floor(rate) + extra).withColumn("taken", F.col("copies") * F.col("size"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it."""
    once = mixed.filter("copies > 0")
    return once.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("__copy")


#: The mix in SQL, over the table ``docs`` with a column ``size``.
MIX_SQL = """
sizes as (select source, sum(size)::bigint as source_size from docs group by source),
placed as (
  select *, 3.0 * source_size::double as most,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w
  from sizes),
-- a level is right when the targets it gives make up the whole
levels as (
  select b.most / b.w as stop, sum(case when a.most / a.w < b.most / b.w then a.most else 0 end) as held,
    sum(case when a.most / a.w < b.most / b.w then 0 else a.w end) as w_left, sum(a.source_size)::double as total
  from placed a, placed b group by b.source, b.most, b.w),
level as (select max((total - held) / w_left) as level from levels where (total - held) / w_left <= stop),
goals as (select source, source_size, least(most, coalesce(level, 0) * w) as target from placed, level),
rated as (
  select d.*, g.source_size, g.target,
    case when g.source_size > 0 then least(g.target / g.source_size, 3.0) else 0 end as rate,
    ('0x' || substr(md5('7|' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint / 4294967296.0::double as coin
  from docs d join goals g on d.source is not distinct from g.source),
mixed as (select *, floor(rate)::bigint + (coin < rate - floor(rate))::bigint as copies from rated)
"""
