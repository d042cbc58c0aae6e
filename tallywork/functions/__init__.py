"""Column functions: text cleaning, dates and exact ratios. All of them build
built-in Spark expressions; none is a Python UDF."""
