"""Metadata-driven batch loading and run auditing on Spark DataFrames."""
