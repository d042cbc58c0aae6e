"""What the operators of this subpackage share: tables, folders, text rules."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: White space that is not yet a single space.
LOOSE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. A local session
    without one gets a temporary folder; a cluster without one is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith(("local[", "local")) or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallywork-")
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 20) -> Iterator[None]:
    """While it holds, actions hand rows to Python in batches of some ``size`` bytes (a larger row
    goes alone). Batches of tens of MB take native memory that the executors don't give back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, LOOSE_SPACE, " ")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that a result names anew, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[df[f"`{name}`"] for name in df.columns if name.lower() not in taken])


def released() -> None:
    """Gives the memory of freed arrays back to the system: a worker lives on after its task."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
