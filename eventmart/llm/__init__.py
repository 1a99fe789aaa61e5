"""Operators for preparing training text: scoring, deduplication, packing, encoding, archives."""
