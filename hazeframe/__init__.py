"""Air-quality panel analytics on Spark DataFrames."""
