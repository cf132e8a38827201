"""Corpus query and analytics operators for PySpark.

Every operator is a plain function from DataFrames (or Columns) to DataFrames
(or Columns), so operators chain with ``DataFrame.transform``.
"""
