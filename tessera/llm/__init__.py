"""Operators of a training-data pipeline over ``documents``; one module each.

Nothing else in the package imports this folder.  ``queries.QUERIES`` and
``queries.ORACLES`` hold the registered queries and their SQL.
"""
