"""Readers, writers and table upserts."""
