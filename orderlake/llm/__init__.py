"""Operators of a training-data pipeline over document, page and conversation tables.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; :mod:`orderlake.llm.queries` holds the thin registered queries.
"""
