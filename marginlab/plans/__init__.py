"""Reports and datasets. Every function takes a Warehouse and returns a DataFrame."""
