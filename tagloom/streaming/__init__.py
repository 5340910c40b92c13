"""The stateless classification columns on streaming DataFrames."""
