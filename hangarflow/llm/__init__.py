"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries and their
SQL answers; each operator has a module of its own and takes and returns DataFrames.
"""
