"""Scans: driver tables, CSV with corrupt-row capture, multi-file union, file manifests."""
