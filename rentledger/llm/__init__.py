"""Operators of a training-data pipeline over documents, pages, labels and embeddings.

Nothing outside this package imports it. ``queries.py`` registers one query per operator.
"""
