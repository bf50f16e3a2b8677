"""Continuous forms of ingest and state."""
