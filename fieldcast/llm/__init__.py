"""Operators of a training-data pipeline: scoring, tokens, packing, near copies, search."""
