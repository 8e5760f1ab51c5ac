"""Operators of a training-data pipeline: quality, personal data, duplicates, mixing, tokens.

Nothing else in the library imports this subpackage.
"""
