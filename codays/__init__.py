"""Places that are active on the same days, found with Spark DataFrames."""
