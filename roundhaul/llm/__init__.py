"""Operators for training-data preparation: near duplicates, tokens, packing, quality, text extraction.

Nothing else in the library imports this package.
"""
