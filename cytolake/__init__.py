"""Single-cell expression analytics on Spark DataFrames."""
