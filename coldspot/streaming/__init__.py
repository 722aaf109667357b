"""Incremental (Structured Streaming) session ingest."""
