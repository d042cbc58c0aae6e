"""Registered queries: every module holds pairs of a Spark query and the SQL that
checks it."""
