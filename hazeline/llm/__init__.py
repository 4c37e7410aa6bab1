"""Operators for preparing training text, each a plain function over DataFrames.

Nothing else in the library imports this subpackage.
"""
