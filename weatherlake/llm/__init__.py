"""Operators for training-data pipelines, and their registered queries.

Nothing else in the library imports this package.
"""
