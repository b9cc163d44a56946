"""millrace: text-corpus preparation on Spark DataFrames."""
