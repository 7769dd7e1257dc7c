"""Table-level operators on DataFrames."""
