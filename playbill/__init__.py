"""Event-listing integration and corpus processing on Spark DataFrames."""
