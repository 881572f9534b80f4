"""Operators of a training-data pipeline over the tables of text: documents, pages and labels.

Nothing else in the library imports this package.
"""
