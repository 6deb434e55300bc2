"""Layered sales warehouse and approximate analytics on Spark DataFrames."""
