"""Operators of a training-data pipeline: fingerprints, tokens, mixing, dedup, filters, extraction."""
