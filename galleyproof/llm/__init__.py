"""Operators for preparing training text: scoring, deduplication, mixing, encoding, packing."""
