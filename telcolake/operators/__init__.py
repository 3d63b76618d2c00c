"""Relational building blocks: deduplication, surrogate keys, key lookup, medians, splits."""
