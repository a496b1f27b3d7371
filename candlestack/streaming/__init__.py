"""Structured Streaming operators (log ingest, metric windows, daily increments)."""
