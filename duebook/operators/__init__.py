"""Domain operators: DataFrames in, DataFrames out, no actions."""
