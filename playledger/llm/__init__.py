"""Operators of a training-data pipeline: language, duplicates, quality, scores, tokens, packing."""
