"""Consumer-lending analytics on Spark DataFrames."""
