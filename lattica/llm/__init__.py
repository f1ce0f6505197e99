"""Operators for preparing training data, kept apart from the rest of the library.

Nothing outside this package imports it.  ``queries`` holds the registered
queries and their SQL.
"""
