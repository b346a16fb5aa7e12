"""siltstone: medallion-lakehouse data operators as Spark plans.

Every operator takes and returns DataFrames (or Columns); nothing is collected
unless its size is bounded by a parameter, and the wall clock is always an argument.
"""
