"""Operators of a training-data pipeline (see the README for the map).

Every operator takes DataFrames and column names, handles null ids and texts,
empty tables and repeated rows as its docstring says, and ignores columns it
was not asked for.  ``queries.py`` binds them to the driver's tables.
"""
