"""plumbline: market-data quality analytics and corpus preparation on Spark DataFrames."""
