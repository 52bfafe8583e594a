"""Operators of a training-data pipeline over corpora of text, pages and vectors.

Every module holds one operator with its own general interface; ``queries`` binds them to the test tables.
"""
