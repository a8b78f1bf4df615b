"""Video statistics lakehouse on plain Spark DataFrames."""
