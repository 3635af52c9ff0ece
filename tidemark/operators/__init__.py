"""DataFrame operators: each takes DataFrames, column names and parameters and returns a DataFrame."""
