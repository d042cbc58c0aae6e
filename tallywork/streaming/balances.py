"""The running balance of every customer on a stream of transactions, with late rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "customer_id bigint, txn_date date, amount decimal(28,2), balance decimal(28,2)"
#: Cents by day since 1970, in the order of days; and the balance before the first of them.
STATE = "days array<int>, cents array<bigint>, settled bigint"


def signed(kind: Column, amount: Column) -> Column:
    """Deposits add, all else takes away."""
    return F.when(kind == "deposit", amount).otherwise(-amount)


def advance(keep_days: int):
    """Take in a batch's rows of one customer; give the balance of each day that changed.

    A late row changes its own day and every later one. Days more than ``keep_days`` before the
    newest are settled: their sum is kept, not the days, so that the state of a customer is bounded;
    a row later than that counts for the first day kept."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        days, settled = {}, 0
        if state.exists:
            known, cents, settled = state.get
            days = dict(zip(known, cents))
        floor = min(days) if days else None
        new: dict[int, int] = {}
        for batch in batches:
            for day, cents in zip(batch["day"], batch["cents"]):
                day = int(day) if floor is None else max(int(day), floor)
                new[day] = new.get(day, 0) + int(cents)
        for day, cents in new.items():
            days[day] = days.get(day, 0) + cents
        order = sorted(days)
        rows, balance, first = [], settled, min(new)
        for day in order:
            balance += days[day]
            if day >= first:
                rows.append((key[0], day, days[day], balance))
        old = [d for d in order if d < order[-1] - keep_days]
        settled += sum(days.pop(d) for d in old)
        left = sorted(days)
        state.update((left, [days[d] for d in left], settled))
        yield pd.DataFrame(rows, columns=["customer_id", "day", "cents", "balance"])

    return step


def running_balances(stream: DataFrame, keep_days: int = 400) -> DataFrame:
    """From a stream (customer_id, txn_date, txn_type, txn_amount) the balance at the end of each day
    that a batch changed; of a day's rows the last one given holds. To be written in update mode.

    State is per customer and survives a restart from the checkpoint folder. NULL customers, days
    and amounts are left out."""
    cents = (signed(F.col("txn_type"), F.col("txn_amount")) * 100).cast("bigint")
    known = stream.filter("customer_id is not null and txn_date is not null and txn_amount is not null")
    rows = known.select("customer_id", F.unix_date(F.col("txn_date").cast("date")).alias("day"), cents.alias("cents"))
    found = rows.groupBy("customer_id").applyInPandasWithState(
        advance(keep_days), "customer_id bigint, day int, cents bigint, balance bigint", STATE, "update", GroupStateTimeout.NoTimeout
    )
    money = lambda c: (F.col(c).cast("decimal(28,0)") / 100).cast("decimal(28,2)").alias("amount" if c == "cents" else c)
    return found.select("customer_id", F.date_from_unix_date("day").alias("txn_date"), money("cents"), money("balance"))
