"""Operators for preparing training data: duplicates, toxicity, quality, PII, formatting, sharding, packing."""
