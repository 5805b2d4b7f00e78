"""Operators for preparing training data, one module per operator.

Nothing else in the library imports this package.  ``catalog`` registers one
query per operator, ``oracle`` holds the DuckDB twin where SQL can express it.
"""
