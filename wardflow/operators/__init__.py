"""User-level operators on DataFrames."""
