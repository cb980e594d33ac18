"""Operators of a training-data pipeline: language, quality, duplicates, tokens, packing, page text.

Nothing else in the library imports this package. Executors need it on their Python path, as any package.
"""
