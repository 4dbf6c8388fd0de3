"""Operators of a training-data pipeline over a ``documents`` table.

Each module holds one operator with its own interface; ``queries`` registers a
thin query per operator.  Nothing outside this package imports it.
"""
