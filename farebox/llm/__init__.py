"""Operators for preparing training data: dedup, filters, scores, mixing, packing."""
