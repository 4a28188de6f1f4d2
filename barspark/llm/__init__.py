"""Operators for large training-text pipelines (documents, conversations, embeddings).

Nothing else in the library imports this package.  Operators take DataFrames and column names;
``queries.py`` holds the thin registered queries that fix production parameters.
"""
