"""Incremental screening with Structured Streaming."""
