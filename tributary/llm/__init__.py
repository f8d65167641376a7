"""Operators for preparing training text, and the queries that run them over the given tables.

Nothing else in the library imports this subpackage. Each operator is one module; ``queries.py``
holds one query per operator and ``sql.py`` the same results in SQL where SQL can express them.
"""
