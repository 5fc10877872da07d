"""Operators for preparing text corpora: mixing, extraction, deduplication, scoring, encoding, sharding."""
