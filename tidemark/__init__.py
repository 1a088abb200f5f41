"""tidemark: incremental loads, table history and fixed analytics on Spark DataFrames."""
