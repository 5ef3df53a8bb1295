"""Operators for building training data: identification, deduplication, filtering, encoding, packing."""
