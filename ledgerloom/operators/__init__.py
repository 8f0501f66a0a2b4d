"""Table-to-table transformations: every function maps DataFrames to a DataFrame."""
