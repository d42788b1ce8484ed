"""Operators a training-data pipeline needs, each a plain function on DataFrames.

Nothing else in the library imports this subpackage; it can be deleted whole.
"""
