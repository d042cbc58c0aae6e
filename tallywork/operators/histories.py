"""As-of joins of two histories: the latest state of one before each row of the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.operators.slices import in_slices, last_known


def as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    values: Sequence[str],
    tie: str,
    order: str,
    inclusive: bool = True,
) -> DataFrame:
    """Every fact with ``values`` of the latest row of ``history`` of the same key: the one with the
    largest ``since`` not after ``at`` (before it, if not ``inclusive``); of those with one
    ``since`` the largest ``tie``. NULL where there is none; a NULL ``at`` or ``since`` never
    matches, a NULL key is a key. ``order`` makes the facts of one key and time distinct.

    Both sides are one sequence per key, so a row is moved once and no pair is built. A key's
    sequence is cut into slices; a slice begins with the last state of those before it."""
    rank = 0 if inclusive else 1  # at one time: the history before the facts, or after them
    state = F.struct(*[F.col(v) for v in values])
    left = facts.select("*", F.col(at).alias("_time"), F.lit(1 - rank).alias("_side"), F.col(order).alias("_tie"), F.lit(None).alias("_state"), F.lit(True).alias("_fact"))
    right = history.filter(F.col(since).isNotNull()).select(
        *keys, F.col(since).alias("_time"), F.lit(rank).alias("_side"), F.col(tie).alias("_tie"), state.alias("_state"), F.lit(False).alias("_fact")
    )
    ordered = ["_time", "_side", "_tie"]
    both = left.withColumn("_state", F.lit(None).cast(right.schema["_state"].dataType)).unionByName(right, allowMissingColumns=True)
    found = last_known(in_slices(both, keys, ordered), keys, ordered, {"_latest": "_state"}).filter("_fact")
    latest = F.when(F.col(at).isNotNull(), F.col("_latest"))
    return found.select(*[F.col(c) for c in facts.columns], *[latest[v].alias(v) for v in values])
