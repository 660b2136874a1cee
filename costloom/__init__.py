"""Cost-attribution analytics on Spark DataFrames."""
