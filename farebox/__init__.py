"""Batch analytics over metered-trip records, written as DataFrame functions."""
