"""Readers of raw inputs, test-data adapters and table sinks."""
