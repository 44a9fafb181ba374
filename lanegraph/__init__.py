"""Logistics network analytics on Spark DataFrames."""
