"""Operators for training-data pipelines on documents, pages and embeddings.

Nothing else in the library imports this package.
"""
