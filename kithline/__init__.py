"""kithline: record linkage on Spark DataFrames."""
