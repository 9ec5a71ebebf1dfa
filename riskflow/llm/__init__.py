"""Operators for training-data pipelines over ``documents`` and ``pages``.

Nothing else in the library imports this package. Every operator takes and returns DataFrames;
``queries.py`` holds the thin registered queries and their SQL.
"""
