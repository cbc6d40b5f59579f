"""Operators for preparing training text: extraction, scans, deduplication, packing, sharding, formatting."""
