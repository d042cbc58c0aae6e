"""Collecting queries and their check SQL under one key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.plans.check_views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]


def doubles(df: DataFrame) -> DataFrame:
    """Decimals leave a registered query as doubles, at the very end."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[F.col(n).cast("double").alias(n) if isinstance(k, T.DecimalType) else F.col(n) for n, k in kinds.items()]
    )


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.checks: dict[str, str] = {}

    def add(self, key: str, query: Query, views: str = "", sql: str | None = None) -> None:
        """``views``: names of the check views the SQL needs, separated by blanks."""
        if key in self.queries:
            raise ValueError(f"query {key} registered twice")
        self.queries[key] = lambda spark, folder: doubles(query(spark, folder))
        if sql is not None:
            self.checks[key] = with_views(views.split(), sql)


def with_views(names: list[str], sql: str) -> str:
    """Put the views a statement needs (and those they need) in front of it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        needs, _ = VIEWS[name]
        for need in needs:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    body = sql.strip()
    if not ordered:
        return body
    head = ",\n".join(f"{name} as ({VIEWS[name][1].strip()})" for name in ordered)
    if body.lower().startswith("with recursive "):
        return f"with recursive {head},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"


def sql_ratio(num: str, den: str, scale: int, factor: int = 1) -> str:
    """SQL for ``factor * num / den`` rounded half away from zero, on whole numbers.

    ``num`` and ``den`` are integers or have two decimals; the result is a double."""
    n = f"cast(({num}) * 100 as hugeint) * {factor}"
    d = f"cast(({den}) * 100 as hugeint)"
    digits = 10**scale
    return (
        f"(case when {d} = 0 then null else sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {digits} + abs({d})) // (2 * abs({d}))) / cast({digits} as double) end)"
    )
