"""Operators: DataFrames and column names in, a DataFrame out. Nothing runs until
the caller asks for a result."""
