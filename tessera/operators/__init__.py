"""Entity-resolution operators: DataFrames in, DataFrames out."""
