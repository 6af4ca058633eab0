"""Operators of a training-data pipeline: deduplication, counting, packing, mixing, scoring, search."""
