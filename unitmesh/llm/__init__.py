"""Operators of a training-data pipeline (deduplication, scans, classifiers, packing,
archives, token counts). Nothing else in the library imports this subpackage."""
