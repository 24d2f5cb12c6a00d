"""Batch/stream-agnostic operators: each takes and returns a DataFrame."""
