"""DataFrame operators. Each takes DataFrames (and column names) and
returns a DataFrame; nothing is collected unless its size is fixed by a
parameter (class list, feature list, parameter grid)."""
