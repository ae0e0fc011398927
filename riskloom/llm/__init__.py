"""Operators for preparing text corpora: filters, near-duplicates, redaction, packing, sharding, chat templates."""
