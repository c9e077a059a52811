"""Corpus operators for large training-data pipelines (filters, dedup, packing, sharding)."""
