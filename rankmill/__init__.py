"""Snapshot, event and recommendation analytics on Spark DataFrames."""
