"""Operators for building training corpora: near-duplicates, sharding, scans, models, tokens, search."""
