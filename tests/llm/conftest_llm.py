from __future__ import annotations

import re

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return docs.select("doc_id", "text", "source").collect()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, a shared id."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    data = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n ", "en", "a", 3), (4, "one", "en", "a", 3),
        (5, long, "en", "b", len(long)), (6, long + " more", "en", None, 1), (7, "same text here now", "de", "b", 1),
        (7, "same text here now", "de", "b", 1), (8, "same \n text here  now", "de", "c", 1), (9, "other", "fr", "c", 1),
        (9, "Others, and more. Of it\n\n\nall", "fr", "c", 1), (None, "no id at all", None, None, None), (None, None, None, None, None),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """The table with more columns, named like those of a result."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in names})


def same(df, other):
    columns = df.columns
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, other.select(columns).collect()), key=key)
