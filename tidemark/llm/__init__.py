"""Operators for large text corpora: encoding, deduplication, quality, search and packing."""
