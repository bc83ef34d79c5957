"""Operators for large-scale training-data preparation (mixing, formatting, dedup, filtering)."""
