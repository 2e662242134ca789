"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage.
"""
