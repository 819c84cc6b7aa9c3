"""Operators for preparing training data: sharding, language ID, extraction, quality, mixing, PII, packing, deduplication, search."""
