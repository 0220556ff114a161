"""Runs the models over the driver's tables: adapter, queries and their SQL twins."""
