"""Operators that prepare training data: search, deduplication, packing, mixing, scoring, counting."""
