"""Incremental tier on Structured Streaming (landing files as they arrive)."""
