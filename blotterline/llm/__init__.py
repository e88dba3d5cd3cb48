"""Operators for training data at scale: sharding, search, packing, deduplication, tokens, models."""
