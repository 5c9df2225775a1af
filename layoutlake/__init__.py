"""Layout-document analytics on Spark DataFrames."""
