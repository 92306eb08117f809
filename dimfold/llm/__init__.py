"""Operators of a training-data pipeline: one module per operator, ``registry`` holds their queries.

Nothing else in the library imports this subpackage.
"""
