"""Public-transport analytics on Spark DataFrames."""
