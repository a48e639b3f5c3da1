"""Operators of a training-data pipeline over the documents, labels and embeddings tables.

Each module holds one operator with a general interface and the thin ``opN_*`` query
over its whole table. Nothing else in the library imports this package.
"""
