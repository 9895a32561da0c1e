"""Interval-usage analytics on Spark DataFrames."""
