"""Incremental ingest with Structured Streaming (file source, availableNow)."""
