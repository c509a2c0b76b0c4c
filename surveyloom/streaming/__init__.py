"""Streaming over DataFrames."""
