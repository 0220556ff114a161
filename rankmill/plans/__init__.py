"""Models and marts as functions from DataFrames to DataFrames."""
