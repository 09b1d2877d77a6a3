"""The catalogue's operators: DataFrames in, DataFrames out, built-in functions only."""
