"""Operators of a training-data pipeline: packing, mixing, deduplication, classifiers, token counts."""
