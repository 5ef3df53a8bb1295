"""DataFrame operators. Each takes and returns DataFrames; none reads a path."""
