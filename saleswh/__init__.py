"""Sales warehouse and analytics on Spark DataFrames."""
