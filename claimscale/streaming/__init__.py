"""Incremental document ingest."""
