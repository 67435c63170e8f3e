"""Operators for training-data pipelines: tokens, packing, quality, PII, near-dedup, URLs, vectors, shards."""
