"""Run registered queries and their check SQL side by side and compare values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


# How the types of the two engines correspond.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def check(query, sql: str, spark, folder: str, con) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    names, kinds = list(relation.columns), [str(t) for t in relation.types]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = dict(zip(names, kinds))
    odd = [(c, t, types[c]) for c, t in df.dtypes if SAME_TYPE.get(t) != types[c]]
    if odd:
        return f"types {odd}"
    want = rows_of(names, relation.fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"value {a} != {b}"
    if not got:
        return "no rows on both sides"
    return None


def main() -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tallywork.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = local_session("8"), connect(folder)
    checks = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in checks:
                said = check(query, checks[name], spark, folder, con)
            else:
                said = None
                print(name, "no SQL, rows:", query(spark, folder).count())
        except Exception as error:  # report and go on with the next query
            said = f"{type(error).__name__}: {str(error)[:600]}"
        bad += said is not None
        print(f"{'ok ' if said is None else 'BAD'} {name} {time.time() - start:.2f}s {said or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
