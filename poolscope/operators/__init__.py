"""DataFrame operators. Each takes DataFrames and parameters and returns a DataFrame."""
