"""Spark-native preparation, profiling, scoring and monitoring of text-training corpora.

Every operator takes DataFrames (or Columns) and returns DataFrames (or Columns).
"""
