"""Operators of a training-data pipeline: deduplication, scoring, tokenizing, packing and search."""
