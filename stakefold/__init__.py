"""Retail-gaming settlement analytics on Spark DataFrames."""
