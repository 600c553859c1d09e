"""Transaction-risk data engine on Spark DataFrames."""
