"""Operators of a training-data pipeline over text: extraction, cleaning, scans, tokens.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers a thin query for each.
"""
