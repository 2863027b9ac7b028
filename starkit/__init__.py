"""Star-schema building blocks on Spark DataFrames."""
