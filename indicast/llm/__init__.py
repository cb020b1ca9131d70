"""Operators of a training-data pipeline over web documents.

Nothing else in the package imports this subpackage. Each module holds one
operator with its general interface; ``queries`` registers the thin ``opN_``
queries and their oracle SQL.
"""
