"""Operators for preparing text corpora: deduplication, classification, tokenization, mixing and sharding."""
