"""Incremental mode of the feature job (Structured Streaming)."""
