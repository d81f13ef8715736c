"""Tableops: batch analytics on Spark tables as plain functions over DataFrames.

Every operator takes and returns a DataFrame, so operators chain with ``df.transform(operator, ...)``.
"""
