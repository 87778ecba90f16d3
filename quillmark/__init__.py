"""A tagging and corpus-building engine on Spark DataFrames."""
