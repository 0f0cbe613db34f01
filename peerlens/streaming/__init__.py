"""Incremental ingest of landed page files with Structured Streaming."""
