"""Survey and question-bank analytics on Spark DataFrames."""
