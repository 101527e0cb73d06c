"""DataFrame operators: each takes and returns DataFrames, no actions on big data."""
