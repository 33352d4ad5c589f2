"""Structured Streaming twins of the batch metrics, and their sinks."""
