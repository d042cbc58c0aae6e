"""Cleaning of dirty text columns and of lists kept in one text cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the raw tables.
NULL_TOKENS = ("", "null")


def normalize_nulls(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL for any of the tokens (blanks around them ignored), else the text."""
    return F.when(~F.lower(F.trim(col)).isin(*tokens), col)


def clean_list(col: Column) -> Column:
    """``'1, 5'`` -> ``'1,5'``; tokens for "no value" become NULL."""
    return F.replace(normalize_nulls(col), F.lit(" "), F.lit(""))


def list_items(col: Column, sep: str = ",") -> Column:
    """Text list -> array of its elements, blanks stripped (NULL stays NULL)."""
    return F.split(F.replace(col, F.lit(" "), F.lit("")), sep)


def list_size(col: Column, sep: str = ",") -> Column:
    """Number of elements of a text list, whatever their width; NULL for NULL."""
    return F.when(col.isNotNull(), F.size(list_items(col, sep)))


def list_ids(col: Column, sep: str = ",") -> Column:
    """Text list -> array of distinct int ids; an empty array for NULL."""
    ids = list_items(col, sep).try_cast("array<int>")
    return F.coalesce(F.array_distinct(ids), F.array().cast("array<int>"))


def leading_number(col: Column) -> Column:
    """``'20km'``, ``'23.4 km'``, ``'32 minutes'`` -> 20.0, 23.4, 32.0; else NULL."""
    return F.regexp_extract(col, r"^\s*(\d+(?:\.\d+)?)", 1).try_cast("double")


def parse_timestamp(col: Column) -> Column:
    """``'2020-01-01 18:15:34'`` -> timestamp without zone; NULL for anything else."""
    return normalize_nulls(col).try_cast("timestamp_ntz")
