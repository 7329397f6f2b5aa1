"""The jobs: DataFrames in, one DataFrame out."""
