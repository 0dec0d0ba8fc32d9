"""Estratos: a layered (bronze, silver, gold) analytics library for official-statistics tables on Spark.

Everything is a plain function from DataFrames (or Columns) to a DataFrame (or Column); nothing runs
until the caller writes or collects the result, apart from the sinks and the few sources that say so.
"""
