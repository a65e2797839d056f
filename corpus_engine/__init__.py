"""News-corpus topic analytics on Spark DataFrames."""
