"""Layout analytics on Spark DataFrames."""
