"""Operators of a training-data pipeline over documents, conversations and embeddings.

Nothing else in the library imports this package. Every operator reads the columns it names and
ignores all others, so extra columns never clash; ``queries`` holds the registered queries.
"""
