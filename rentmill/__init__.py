"""Layered rental analytics on Spark DataFrames."""
