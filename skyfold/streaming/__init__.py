"""Structured Streaming ingest of landing files."""
