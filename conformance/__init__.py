"""Checks of every operator against DuckDB on the driver's tables."""
