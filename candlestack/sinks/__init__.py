"""Sinks: point / document rendering, keyed upsert, landing, batched writers."""
