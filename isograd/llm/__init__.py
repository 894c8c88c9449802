"""Operators for preparing training text: filters, deduplication, packing, scoring.

Nothing else in the library imports this package.
"""
