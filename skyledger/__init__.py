"""Surface-weather observation analytics on Spark DataFrames."""
