"""Incremental loads, as batch operators and on Structured Streaming."""
