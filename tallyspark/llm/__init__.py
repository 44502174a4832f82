"""Operators for preparing training data: filters, deduplication, tokenizing, scoring and packing."""
