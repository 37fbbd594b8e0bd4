"""Column expressions: each function takes columns and returns a column."""
