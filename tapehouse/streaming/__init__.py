"""Structured Streaming jobs (bronze ingest)."""
