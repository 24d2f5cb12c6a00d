"""Structured Streaming side: stateful processors (rolling values, count windows,
custom triggers), the foreachBatch late-data operator and run-mode helpers."""
