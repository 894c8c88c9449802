"""Gridded-weather analytics written as plain Spark DataFrame operators.

A grid is a long DataFrame: one row per (valid_time, latitude, longitude) and
one column per variable.  Every operator takes DataFrames and returns a lazy
DataFrame; only the functions in :mod:`isograd.plans` that write result tables
run jobs themselves.
"""

__version__ = "0.1.0"
