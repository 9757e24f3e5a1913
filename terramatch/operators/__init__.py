"""Operators of the matching pipeline, DataFrame to DataFrame."""
