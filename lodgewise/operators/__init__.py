"""Table operators: DataFrames and plain parameters in, a DataFrame out."""
