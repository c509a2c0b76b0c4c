"""Operators over DataFrames."""
