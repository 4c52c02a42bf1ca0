"""Operators for preparing training data: each module is one operator on DataFrames.

Nothing else in the library imports this package.
"""
