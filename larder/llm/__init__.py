"""Operators for training-data pipelines over document tables.

Nothing outside this package imports it.  Each module holds one operator with a
general interface; ``queries`` holds the thin registered queries.
"""
