"""Parquet in and out, and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared schemas of the tables the views read; reading footers to infer them
# would cost a job per table and query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name; columns and filters are pushed into the scan by its readers."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a derived table (replacing an older copy) and read it back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> DataFrame:
    """Write rows into a stored table; only partitions that ``df`` has rows of are replaced, the
    others keep their files."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: list[str]) -> DataFrame:
    """Add rows to a stored table; files that exist stay as they are."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def rewrite_where(spark: SparkSession, path: str, partition_by: list[str], where: Column, changes: dict[str, Column]) -> DataFrame:
    """Change columns of the rows that meet a condition, in the stored table. Only partitions with
    such rows are read whole and written; the partition columns themselves can't change.

    The new partitions are written beside the table first and then put in its place, so a job that
    fails on the way leaves the table as it was."""
    if set(changes) & set(partition_by):
        raise ValueError("partition columns stay")
    stored = spark.read.parquet(path)
    touched = cut_lineage(stored.filter(where).select(*partition_by).distinct())
    same = reduce(lambda a, b: a & b, [stored[c].eqNullSafe(touched[c]) for c in partition_by])
    rows = stored.join(touched, same, "left_semi")
    kinds = dict(stored.dtypes)
    changed = rows.withColumns({c: F.when(where, new.cast(kinds[c])).otherwise(F.col(c)) for c, new in changes.items()})
    return replace_partitions(cut_lineage(changed), path, partition_by)


def store_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a derived table whose rows are dealt out by ``keys`` for good: tables with equal keys
    and numbers of buckets join and group without a shuffle. Choose ``buckets`` so that one holds
    100-200 MB. The table is named in the session's catalogue; the files lie under ``path``."""
    df.sparkSession.sql(f"drop table if exists {name}")
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a derived table for the length of the session, for SQL over it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, for tables a query derives on its way."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tallywork-"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def preview(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names. A session on one
    machine may go without one; on a cluster, whose executors share no temporary folder, that is
    an error."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
