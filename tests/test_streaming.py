from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallywork.sources.tables import SCHEMAS, load
from tallywork.streaming import balances, hourly

FOLDER = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "events"
    load(spark, FOLDER, "events").repartition(3).write.parquet(str(source))
    stream = hourly.counts_per_hour(hourly.read_events(spark, str(source), SCHEMAS["events"], 1))
    query = (
        stream.writeStream.format("memory").queryName("hours").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = sorted(tuple(r) for r in hourly.by_hour_of_day(spark.table("hours")).collect())
    batch = load(spark, FOLDER, "events").groupBy(F.hour("ts")).count()
    assert got == sorted(tuple(r) for r in batch.collect())


def balances_after(spark, tmp_path, batches):
    """Each list of rows is a batch and a run of its own; what the stream gave, in order."""
    source, checkpoint, out = (str(tmp_path / x) for x in ("in", "checkpoint", "out"))
    kinds = "customer_id long, txn_date date, txn_type string, txn_amount decimal(18,2)"
    given = []
    for rows in batches:
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(source)
        stream = balances.running_balances(spark.readStream.schema(kinds).parquet(source), keep_days=30)

        def keep(df, number):
            given.append(sorted(tuple(r) for r in df.collect()))

        query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(120)
    return given


def test_running_balance_with_late_rows_and_restarts(spark, tmp_path):
    day = lambda n: dt.date(2024, 3, 1) + dt.timedelta(n)
    d = lambda x: Decimal(x).quantize(Decimal("0.01"))
    first = [(1, day(0), "deposit", d(10)), (1, day(2), "purchase", d(3)), (2, day(1), "withdrawal", d(5)), (1, day(2), "deposit", d(1)), (None, day(1), "deposit", d(1))]
    late = [(1, day(1), "deposit", d("0.5")), (2, day(4), "deposit", d(7))]
    far = [(1, day(60), "deposit", d(100))]
    settled = [(1, day(0), "purchase", d(2))]
    got = balances_after(spark, tmp_path, [first, late, far, settled])
    assert got[0] == [(1, day(0), d(10), d(10)), (1, day(2), d(-2), d(8)), (2, day(1), d(-5), d(-5))]
    assert got[1] == [(1, day(1), d("0.5"), d("10.5")), (1, day(2), d(-2), d("8.5")), (2, day(4), d(7), d(2))]
    assert got[2] == [(1, day(60), d(100), d("108.5"))]
    assert got[3] == [(1, day(60), d(98), d("106.5"))]  # later than the days kept: counts for the first of them
