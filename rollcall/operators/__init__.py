"""DataFrame jobs: DataFrames in, DataFrame out."""
