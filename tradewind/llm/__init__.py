"""Operators for preparing training text: deduplication, classifiers, mixing, packing, search."""
