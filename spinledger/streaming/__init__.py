"""Structured Streaming twins of the ingest and refresh steps."""
