"""Florilege: quotation analytics and corpus preparation on Spark DataFrames."""
