"""Operators for building training corpora out of a table of documents."""
