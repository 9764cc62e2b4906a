"""Operators of a training-data pipeline: quality, dedup, fingerprints, tokens, mixing, sharding."""
