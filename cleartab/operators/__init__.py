"""Table-level operators. Every function maps DataFrames to DataFrames."""
