"""Card payments matching and star-schema analytics on Spark DataFrames."""
