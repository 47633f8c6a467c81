"""Landing, lake registration and reporting operators on Spark DataFrames."""
