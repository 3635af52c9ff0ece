"""Interval, read, sequence and score analytics on Spark DataFrames."""
