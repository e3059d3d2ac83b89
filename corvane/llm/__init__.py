"""Operators for training-data pipelines: archives, duplicates, language, quality, shards, packing.

Nothing else in the library imports this subpackage.
"""
