"""Reusable operators: DataFrames in, DataFrame out, no action inside."""
