"""Operators for preparing text corpora: search, filters, deduplication, packing, tokens."""
