"""Operators of the library: each takes DataFrames and returns a lazy DataFrame."""
