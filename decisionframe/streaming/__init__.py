"""Incremental ingest of outcomes as streams."""
