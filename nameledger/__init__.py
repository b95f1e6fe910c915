"""Passive-DNS analytics on Spark DataFrames, batch and streaming."""
