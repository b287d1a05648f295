"""Incremental capture with Structured Streaming."""
